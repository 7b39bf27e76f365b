"""Versioned snapshot of the marts and the file exports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.contracts import SNAPSHOT_SCHEMA_VERSION
from riskmart.operators import analytics as A

CURRENT_SCHEMA = "schema_version int, snapshot_id string, exported_at string, table_name string, path string"


class SnapshotError(RuntimeError):
    """A snapshot is missing, empty or of another version."""


def write_snapshot(root: str, tables: Mapping[str, DataFrame], version: int = SNAPSHOT_SCHEMA_VERSION) -> str:
    """Writes all tables under a new id, then names that id as current.

    Readers follow the newest complete manifest, so they never see half a snapshot.
    """
    at = datetime.now(UTC)
    snapshot_id = at.strftime("%Y%m%dT%H%M%S%fZ")
    rows = []
    for name, df in tables.items():
        path = f"{root}/snapshot_id={snapshot_id}/{name}"
        df.write.parquet(path)
        rows.append((version, snapshot_id, at.isoformat(timespec="seconds"), name, path))
    spark = next(iter(tables.values())).sparkSession
    manifest = spark.createDataFrame(rows, CURRENT_SCHEMA).coalesce(1)
    manifest.write.mode("append").parquet(f"{root}/current")
    return snapshot_id


def read_snapshot(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Tables of the newest snapshot."""
    manifest = spark.read.schema(CURRENT_SCHEMA).parquet(f"{root}/current")
    rows = manifest.where(F.col("snapshot_id") == manifest.agg(F.max("snapshot_id")).scalar()).collect()
    if not rows or any(r.schema_version != SNAPSHOT_SCHEMA_VERSION for r in rows):
        raise SnapshotError("incompatible snapshot version; export it again")
    return {r.table_name: spark.read.parquet(r.path) for r in rows}


def check_snapshot(tables: Mapping[str, DataFrame], layouts: Mapping[str, tuple[str, ...]]) -> None:
    """Every table must be there, have its columns and hold at least one row."""
    for name, columns in layouts.items():
        if name not in tables or tuple(tables[name].columns) != columns or tables[name].isEmpty():
            raise SnapshotError(f"invalid snapshot table: {name}")


LAYOUTS = {
    "monthly": ("month", "state", "premium", "claims", "observations"),
    "companies": ("year", "state", "company", "premium", "claims"),
    "products": ("year", "state", "product", "premium", "claims"),
    "segments": ("state", "gender", "age", "observations", "exposure", "premium", "claim_count", "claims", "has_claim"),
    "bands": ("state", "band", "observations", "score_sum", "positives"),
}


def export_market_csv(monthly: DataFrame, path: str, state: str = A.ALL, years: tuple[int, int] = (1, 9999)) -> None:
    A.select_market(monthly, state, years).write.mode("overwrite").option("header", True).csv(path)


def export_risk_csv(segments: DataFrame, path: str, state: str = A.ALL) -> None:
    A.export_segments(A.select_risk(segments, state)).write.mode("overwrite").option("header", True).csv(path)


def write_profile(profile: DataFrame, path: str) -> None:
    """A profile as JSON lines and as one CSV row per column."""
    profile.write.mode("overwrite").json(f"{path}/json")
    profile.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
