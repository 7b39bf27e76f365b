"""Load jobs: files to published batches, safe to re-run.

Rows are written under their ``batch_id`` first; a batch counts only once its
SUCCESS event is appended, and every reader joins against those events. A run
that dies half way leaves rows no reader sees, and the next run drops them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators import batches as B
from riskmart.operators.row_contracts import (
    SourceContractError,
    apply_market_contract,
    apply_risk_contract,
    require_clean,
    split_rows,
)
from riskmart.sources import csv_contract as S
from riskmart.sources.tables import delete_folder, new_folder, read_or_empty, work_folder, write_table

EVENT_SCHEMA = (
    "batch_id string, source_file string, source_version string, status string, event_seq bigint, "
    "expected_rows bigint, accepted_rows bigint, rejected_rows bigint, elapsed_ms bigint, error string, event_at timestamp"
)
AUDIT_SCHEMA = "batch_id string, stage string, status string, rows_affected bigint, detail string, event_at timestamp"
VERSION_SCHEMA = "source_file string, source_version string, length bigint"
MANIFEST_SCHEMA = "source_file string, expected_source_rows bigint, expected_source_bytes bigint, is_canonical boolean"


@dataclass(frozen=True)
class LoadResult:
    batch_id: str
    outcome: str  # SUCCESS or SKIPPED
    source_rows: int
    accepted_rows: int
    rejected_rows: int


class LoadError(RuntimeError):
    """A load failed its count checks."""


class Store:
    """Folder layout of one track's tables."""

    def __init__(self, spark: SparkSession, root: str, contract: C.SourceContract):
        self.spark, self.root, self.contract = spark, root, contract

    def path(self, name: str) -> str:
        return f"{self.root}/{self.contract.name}_{name}"

    def read(self, name: str, schema: str) -> DataFrame:
        return read_or_empty(self.spark, self.path(name), schema)

    def append(self, name: str, schema: str, row: tuple) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(self.path(name))

    def events(self) -> DataFrame:
        return self.read("batch_events", EVENT_SCHEMA)

    def batches(self) -> DataFrame:
        return B.latest_state(self.events())

    def audit(self, batch_id: str | None, stage: str, status: str, rows: int | None, detail: str) -> None:
        self.append("audit", AUDIT_SCHEMA, (batch_id, stage, status, rows, detail[: C.REASON_LIMIT], now()))

    def rows(self, name: str) -> DataFrame | None:
        """Stored rows of a table with all its partitions, or None before the first load."""
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def published(self, name: str = "staging") -> DataFrame:
        """Rows of SUCCESS batches only."""
        done = self.batches().where(F.col("status") == B.SUCCESS).select("batch_id")
        return self.rows(name).join(done, "batch_id", "left_semi")

    def stored_counts(self, batch_ids: Sequence[str]) -> DataFrame:
        """Physical rows of some batches; only their partitions are read."""
        empty = self.spark.createDataFrame([], "batch_id string")
        sides = [self.rows(name) for name in ("staging", "rejects")]
        return B.stored_counts(*[empty if side is None else side.where(F.col("batch_id").isin(list(batch_ids))) for side in sides])

    def batches_of(self, source_file: str, version: str | None = None) -> DataFrame:
        """Batches of a source by name, or by name and content."""
        match = F.col("source_file") == source_file
        return self.batches().where(match & (F.col("source_version") == version) if version else match)

    def drop_open(self, source_file: str, version: str | None) -> None:
        """Empties the partitions of failed or unfinished batches of a source (of all its versions without one)."""
        open_batches = self.batches_of(source_file, version).where(F.col("status") != B.SUCCESS)
        for row in open_batches.select("batch_id").collect():
            for name in ("staging", "rejects"):
                delete_folder(self.spark, f"{self.path(name)}/batch_id={row.batch_id}")

    def publish(self, df: DataFrame, name: str, batch_id: str) -> None:
        df.drop("batch_id").write.mode("overwrite").parquet(f"{self.path(name)}/batch_id={batch_id}")


def now():
    from datetime import UTC, datetime

    return datetime.now(UTC)


def _load(
    store: Store, path: str, manifest: DataFrame, by_content: bool
) -> LoadResult:
    spark, contract = store.spark, store.contract
    S.check_header(spark, [path], contract)
    with work_folder(spark, "version") as folder:
        version = spark.createDataFrame(S.fingerprints(spark, [path], folder).collect(), VERSION_SCHEMA)  # one file
    S.require_manifest(version, manifest)
    source = version.join(manifest.where("is_canonical"), "source_file").first()
    name, expected = source.source_file, source.expected_source_rows

    incoming = version.select("source_file", "source_version")
    own = store.batches_of(name, source.source_version if by_content else None)
    stored = store.stored_counts([r.batch_id for r in own.select("batch_id").collect()])  # the batches of one file
    action = B.load_plan(incoming, own, stored, by_content).first().action
    if action == "BROKEN":
        raise LoadError(f"{name}: the SUCCESS batch no longer matches its stored rows")
    if action == "SKIP":
        last = own.where(F.col("status") == B.SUCCESS).orderBy(F.desc("event_seq")).first()
        store.audit(last.batch_id, "STAGING_LOAD", "SKIPPED", 0, "source already loaded; no rows added")
        return LoadResult(last.batch_id, "SKIPPED", expected, last.accepted_rows, last.rejected_rows)
    if action == "RETRY":
        # A source known by its name replaces whatever content failed under it.
        store.drop_open(name, source.source_version if by_content else None)

    batch_id, started = str(uuid.uuid4()), now()

    def event(status: str, accepted: int | None, rejected: int | None, error: str | None = None) -> None:
        elapsed = int((now() - started).total_seconds() * 1000)
        sequence = int(now().timestamp() * 1_000_000)
        store.append(
            "batch_events",
            EVENT_SCHEMA,
            (batch_id, name, source.source_version, status, sequence, expected, accepted, rejected, elapsed,
             error and error[: C.REASON_LIMIT], now()),
        )

    event(B.RUNNING, None, None)
    store.audit(batch_id, "STAGING_LOAD", "STARTED", 0, "source is read only")
    work = new_folder(spark, "load")
    try:
        raw = S.land_with_row_numbers(spark, [path], contract, f"{work}/landing")
        apply = apply_market_contract if contract is C.MARKET else apply_risk_contract
        judged = apply(raw).withColumns(
            {"source_version": F.lit(source.source_version), "loaded_at": F.current_timestamp()}
        )
        checked = write_table(judged.drop("cells", "extra_cells", "raw_line"), f"{work}/checked")
        delete_folder(spark, f"{work}/landing")
        if contract.policy == "fail_fast":
            require_clean(checked)
        accepted, rejected = split_rows(checked)
        store.publish(accepted, "staging", batch_id)
        if contract.policy == "quarantine":
            columns = ["source_file", "source_version", "source_row_number", "record_hash", "raw_payload", "reject_reason"]
            store.publish(rejected.select(*columns), "rejects", batch_id)
        counts = checked.agg(
            F.count("*").alias("n"), F.count_if(F.col("reject_reason").isNull()).alias("good")
        ).first()
        stored = store.stored_counts([batch_id]).first()
        kept = (stored.stored_accepted, stored.stored_rejected) if stored else (0, 0)
        if counts.n != expected:
            raise SourceContractError(f"{name}: {counts.n} rows, manifest expects {expected}")
        if kept != (counts.good, counts.n - counts.good):
            raise LoadError(f"{name}: stored rows {kept} differ from judged rows {(counts.good, counts.n - counts.good)}")
    except Exception as error:
        event(B.FAILED, None, None, str(error))
        store.audit(batch_id, "STAGING_LOAD", "FAILED", None, str(error))
        raise
    finally:
        delete_folder(spark, work)
    event(B.SUCCESS, counts.good, counts.n - counts.good)
    store.audit(batch_id, "STAGING_LOAD", "SUCCESS", counts.good, f"source={counts.n}; accepted={counts.good}")
    return LoadResult(batch_id, "SUCCESS", counts.n, counts.good, counts.n - counts.good)


def load_market(spark: SparkSession, path: str, root: str, manifest: DataFrame) -> LoadResult:
    """Market CSV: bad rows go to the reject table, the version is its content."""
    return _load(Store(spark, root, C.MARKET), path, manifest, by_content=True)


def load_risk(spark: SparkSession, paths: Sequence[str], root: str, manifest: DataFrame) -> list[LoadResult]:
    """Risk CSV files: any bad row stops its file, a loaded name is skipped."""
    store = Store(spark, root, C.RISK)
    return [_load(store, path, manifest, by_content=False) for path in paths]
