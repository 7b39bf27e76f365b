"""Warehouse refresh: published staging to stored dimensions and facts, incrementally.

Everything a refresh writes lies under its ``refresh_id`` and counts only once its
SUCCESS event is appended; readers see the dimensions of the last SUCCESS refresh
and the facts of all of them. A refresh that fails at any step (guard, dimensions,
fact, reconciliation, gate) therefore changes nothing, and the next one starts from
the same state. One refresh of a track runs at a time: new keys follow the highest
stored one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators import batches as B
from riskmart.operators import quality as Q
from riskmart.operators import warehouse as W
from riskmart.operators.row_contracts import apply_market_contract
from riskmart.plans.loads import Store, now
from riskmart.sources import csv_contract as S
from riskmart.sources.tables import broadcast_if_small, delete_folder, work_folder, write_table

REFRESH_SCHEMA = "refresh_id string, status string, event_seq bigint, members_added bigint, facts_added bigint, error string, event_at timestamp"
LEDGER_SCHEMA = "refresh_id string, batch_id string"
RUN_SCHEMA = (
    "batch_id string, source_rows bigint, staging_rows bigint, fact_rows bigint, source_premiums string, staging_premiums string, "
    "fact_premiums string, source_claims string, staging_claims string, fact_claims string, status string, run_at timestamp"
)
RISK_DIMENSIONS = {spec[0].lower(): spec for spec in (W.DRIVER, W.VEHICLE, W.GEOGRAPHY)}


class ReconciliationError(RuntimeError):
    """Source, staging and fact of a batch do not agree."""


@dataclass(frozen=True)
class RefreshResult:
    refresh_id: str
    members_added: int
    facts_added: int


class Warehouse:
    """Stored dimensions and facts of one track."""

    def __init__(self, spark: SparkSession, root: str, contract: C.SourceContract):
        self.spark, self.store = spark, Store(spark, root, contract)

    def refreshes(self) -> DataFrame:
        events = self.store.read("refresh_events", REFRESH_SCHEMA)
        return events.groupBy("refresh_id").agg(F.max_by("status", "event_seq").alias("status"), F.max("event_seq").alias("event_seq"))

    def last(self) -> str | None:
        row = self.refreshes().where(F.col("status") == B.SUCCESS).orderBy(F.desc("event_seq")).first()
        return row and row.refresh_id

    def dimension(self, name: str) -> DataFrame | None:
        last = self.last()
        return None if last is None else self.spark.read.parquet(f"{self.store.path('dim_' + name)}/refresh_id={last}")

    def fact(self) -> DataFrame | None:
        if self.last() is None:
            return None
        done = self.refreshes().where(F.col("status") == B.SUCCESS).select("refresh_id")
        return self.store.rows("fact").join(broadcast_if_small(done), "refresh_id", "left_semi").drop("refresh_id")

    def open_batches(self) -> DataFrame:
        """SUCCESS batches whose rows no SUCCESS refresh has taken: batch_id, source_file, source_version."""
        done = self.refreshes().where(F.col("status") == B.SUCCESS).select("refresh_id")
        taken = self.store.read("refresh_batches", LEDGER_SCHEMA).join(done, "refresh_id", "left_semi").select("batch_id")
        return self.store.batches().where(F.col("status") == B.SUCCESS).join(taken, "batch_id", "left_anti").select("batch_id", "source_file", "source_version")

    def new_rows(self, batches: Sequence) -> DataFrame:
        """Staged rows of some batches: a literal list prunes the partitions that are read."""
        return self.store.rows("staging").where(F.col("batch_id").isin([b.batch_id for b in batches]))

    def runs(self) -> DataFrame:
        return self.store.read("reconciliations", RUN_SCHEMA)

    def batches(self) -> DataFrame:
        expected = self.store.events().groupBy("batch_id").agg(F.max("expected_rows").alias("expected_source_rows"))
        return self.store.batches().join(expected, "batch_id")

    def event(self, refresh_id: str, status: str, members: int | None = None, facts: int | None = None, error: str | None = None) -> None:
        at = now()
        self.store.append("refresh_events", REFRESH_SCHEMA, (refresh_id, status, int(at.timestamp() * 1_000_000), members, facts, error and error[: C.REASON_LIMIT], at))


def _extend(warehouse: Warehouse, refresh_id: str, members: Mapping[str, DataFrame], first: Callable[[str], DataFrame]) -> tuple[dict[str, DataFrame], int]:
    """Writes every dimension with its new members; existing keys never change."""
    dims, added = {}, 0
    for name, candidates in members.items():
        existing = warehouse.dimension(name)
        whole = first(name) if existing is None else W.extend_dimension(existing, candidates, f"{name}_key")
        dims[name] = write_table(whole, f"{warehouse.store.path('dim_' + name)}/refresh_id={refresh_id}")
        added += dims[name].count() - (0 if existing is None else existing.count())
    return dims, added


def _append(warehouse: Warehouse, refresh_id: str, candidates: DataFrame, batches: Sequence) -> tuple[DataFrame, int]:
    """Writes the facts of new batches that are not stored yet; returns all facts as they would be published.

    Only a batch of the same file can hold the same rows, so stored facts of other files are not compared.
    """
    existing = warehouse.fact()
    new = candidates
    if existing is not None:
        same = F.col("source_file").isin(sorted({b.source_file for b in batches})) & F.col("source_version").isin(sorted({b.source_version for b in batches}))
        new = W.missing_facts(candidates, existing.where(same), Q.IDENTITY)
    ledger = [(refresh_id, b.batch_id) for b in batches]
    if ledger:
        warehouse.spark.createDataFrame(ledger, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(warehouse.store.path("refresh_batches"))
    written = write_table(new, f"{warehouse.store.path('fact')}/refresh_id={refresh_id}")
    return written if existing is None else existing.unionByName(written), written.count()


def _refresh(warehouse: Warehouse, steps: Callable[[str], tuple[int, int]]) -> RefreshResult:
    """Runs the steps under a new id between a RUNNING and a SUCCESS or FAILED event, with audit rows."""
    refresh_id, store = str(uuid.uuid4()), warehouse.store
    warehouse.event(refresh_id, B.RUNNING)
    store.audit(refresh_id, "WAREHOUSE_REFRESH", "STARTED", 0, "dimensions, fact, reconciliation, gate")
    try:
        members, facts = steps(refresh_id)
    except Exception as error:
        warehouse.event(refresh_id, B.FAILED, error=str(error))
        store.audit(refresh_id, "WAREHOUSE_REFRESH", "FAILED", None, str(error))
        for name in ("fact", *(f"dim_{d}" for d in (*W.MARKET_KEYS, *RISK_DIMENSIONS))):
            delete_folder(warehouse.spark, f"{store.path(name)}/refresh_id={refresh_id}")
        raise
    warehouse.event(refresh_id, B.SUCCESS, members, facts)
    store.audit(refresh_id, "WAREHOUSE_REFRESH", "SUCCESS", facts, f"members added={members}; facts added={facts}")
    return RefreshResult(refresh_id, members, facts)


def reconcile_files(warehouse: Warehouse, paths: Sequence[str], fact: DataFrame) -> None:
    """Reads the CSV files again and compares source, staging and fact of every batch that has no SUCCESS run yet; each run is stored.

    Raises if a layer differs, or if the file of an open batch was not given.
    """
    spark, store = warehouse.spark, warehouse.store
    done = warehouse.runs().where(F.col("status") == B.SUCCESS).select("batch_id").distinct()
    open_batches = warehouse.batches().where(F.col("status") == B.SUCCESS).join(done, "batch_id", "left_anti")
    if open_batches.isEmpty():
        return
    with work_folder(spark, "reconcile") as folder:
        versions = write_table(S.fingerprints(spark, paths, f"{folder}/lines"), f"{folder}/versions")
        parsed = apply_market_contract(S.land_with_row_numbers(spark, paths, C.MARKET, f"{folder}/landing"))
        good = F.col("reject_reason").isNull()
        source = parsed.select("source_file", *[F.when(good, F.col(c)).alias(c) for c in ("premiums", "claims")])
        named = open_batches.join(versions, ["source_file", "source_version"]).select("batch_id", "source_file")
        layers = Q.reconcile_layers(open_batches, source.join(F.broadcast(named), "source_file"), store.published(), fact)
        texts = [f"{layer}_{m}" for m in ("premiums", "claims") for layer in ("source", "staging", "fact")]
        runs = write_table(layers.select(
            "batch_id", "source_rows", "staging_rows", "fact_rows", *[F.col(c).cast("string").alias(c) for c in texts], "status", F.current_timestamp().alias("run_at")
        ), f"{folder}/runs")
        runs.coalesce(1).write.mode("append").parquet(store.path("reconciliations"))
        bad = runs.where(F.col("status") != B.SUCCESS).orderBy("batch_id").first()
    store.audit(None, "RECONCILIATION", B.FAILED if bad else B.SUCCESS, None, f"files={len(paths)}")
    if bad:
        raise ReconciliationError(f"batch {bad.batch_id}: source {bad.source_rows}, staging {bad.staging_rows}, fact {bad.fact_rows} rows, or totals differ")


def refresh_market(spark: SparkSession, root: str, paths: Sequence[str]) -> RefreshResult:
    """Guard, four dimensions, fact, three-layer reconciliation from the CSV files, gate."""
    warehouse = Warehouse(spark, root, C.MARKET)
    store = warehouse.store

    def steps(refresh_id: str) -> tuple[int, int]:
        B.successful(store.batches())
        staging = store.published()
        W.require_one_name(staging)
        batches = warehouse.open_batches().collect()  # a row for each file loaded since the last refresh
        new = warehouse.new_rows(batches)
        keyed = W.market_dimensions(new)
        dims, members = _extend(warehouse, refresh_id, W.market_members(new), keyed.__getitem__)
        fact, added = _append(warehouse, refresh_id, W.fact_market(new, dims, store.batches()), batches)
        reconcile_files(warehouse, paths, fact)
        gate = Q.market_gate(
            staging, store.published("rejects"), warehouse.batches(), fact, dims, warehouse.runs(), layout=C.MARKET_STAGING_COLUMNS
        )
        Q.run_gate(gate, refresh_id, store.path("gate_log"))
        store.audit(refresh_id, "QUALITY_GATE", B.SUCCESS, None, "market gate")
        return members, added

    return _refresh(warehouse, steps)


def refresh_risk(spark: SparkSession, root: str, manifest: DataFrame, known_duplicates: int = 0) -> RefreshResult:
    """Three dimensions with their unknown members, fact, gate. ``manifest`` lists the files with their expected rows."""
    warehouse = Warehouse(spark, root, C.RISK)
    store = warehouse.store

    def steps(refresh_id: str) -> tuple[int, int]:
        B.successful(store.batches())
        published = store.published()
        staging = published.withColumnsRenamed(W.RISK_STAGING_TO_SNAKE)
        batches = warehouse.open_batches().collect()  # a row for each file loaded since the last refresh
        new = warehouse.new_rows(batches).withColumnsRenamed(W.RISK_STAGING_TO_SNAKE)
        members = {name: W.members(new, *spec) for name, spec in RISK_DIMENSIONS.items()}
        dims, added_members = _extend(warehouse, refresh_id, members, lambda name: W.risk_dimension(new, RISK_DIMENSIONS[name]))
        fact, added = _append(warehouse, refresh_id, W.fact_risk(new, dims), batches)
        loaded = manifest.where("is_canonical").select("source_file", "expected_source_rows")
        gate = Q.risk_gate(staging, fact, dims, loaded, known_duplicates, layout=[W.RISK_STAGING_TO_SNAKE.get(c, c) for c in C.RISK_STAGING_COLUMNS])
        Q.run_gate(gate, refresh_id, store.path("gate_log"))
        store.audit(refresh_id, "QUALITY_GATE", B.SUCCESS, None, "risk gate")
        return added_members, added

    return _refresh(warehouse, steps)
