"""Load history: batch states, the idempotent load plan, count checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"


def latest_state(events: DataFrame) -> DataFrame:
    """Current state of every batch: its last event. Events are only ever appended."""
    last = F.max_by(F.struct("source_file", "source_version", "status", "accepted_rows", "rejected_rows"), "event_seq")
    latest = events.groupBy("batch_id").agg(last.alias("last"), F.max("event_seq").alias("event_seq"))
    return latest.select("batch_id", "event_seq", "last.*")


def successful(batches: DataFrame, needed: int = 1) -> int:
    """Number of SUCCESS batches; raises below the number a run needs."""
    count = batches.where(F.col("status") == SUCCESS).count()
    if count < needed:
        raise RuntimeError(f"expected at least {needed} SUCCESS batches, found {count}")
    return count


def load_plan(incoming: DataFrame, batches: DataFrame, stored: DataFrame, by_content: bool = True) -> DataFrame:
    """What to do with each incoming source.

    ``SKIP`` a source that succeeded before (same content, or just the same name
    with ``by_content=False``); ``BROKEN`` if its stored rows no longer match;
    ``RETRY`` after a failed or unfinished batch, whose rows are dropped first;
    otherwise ``LOAD``. ``stored`` holds the physical row counts per batch.
    """
    key = ["source_file", "source_version"] if by_content else ["source_file"]
    counted = batches.join(stored, "batch_id", "left")
    intact = (F.col("accepted_rows") == F.coalesce("stored_accepted", F.lit(0))) & (
        F.col("rejected_rows") == F.coalesce("stored_rejected", F.lit(0))
    )
    done = F.col("status") == SUCCESS
    # The newest SUCCESS batch decides, as in a descending TOP 1.
    newest = F.max(F.when(done, F.col("event_seq") * 2 + F.when(intact, 1).otherwise(0)))
    history = counted.groupBy(*key).agg(newest.alias("_newest"), F.count_if(~done).alias("_open"))
    if by_content:
        decided = F.when(F.col("_newest") % 2 == 1, "SKIP").when(F.col("_newest").isNotNull(), "BROKEN")
    else:
        decided = F.when(F.col("_newest").isNotNull(), "SKIP")
    action = decided.when(F.coalesce("_open", F.lit(0)) > 0, "RETRY").otherwise("LOAD")
    return incoming.join(history, key, "left").select(*incoming.columns, action.alias("action"))


def stored_counts(staged: DataFrame, rejected: DataFrame) -> DataFrame:
    """Physical rows per batch on both sides of the split."""
    both = staged.select("batch_id", F.lit(1).alias("a"), F.lit(0).alias("r")).unionAll(
        rejected.select("batch_id", F.lit(0).alias("a"), F.lit(1).alias("r"))
    )
    return both.groupBy("batch_id").agg(F.sum("a").alias("stored_accepted"), F.sum("r").alias("stored_rejected"))


def load_reconciliation(checked: DataFrame, manifest: DataFrame, key: str = "batch_id") -> DataFrame:
    """Source = accepted + rejected = manifest, per batch, from one aggregate pass."""
    good = F.col("reject_reason").isNull()
    counts = checked.groupBy(key).agg(
        F.count("*").alias("source_rows"), F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected")
    )
    matched = manifest.select(key, "expected_source_rows").join(counts, key, "left").fillna(0)
    holds = (F.col("source_rows") == F.col("expected_source_rows")) & (
        F.col("source_rows") == F.col("accepted") + F.col("rejected")
    )
    return matched.withColumn("status", F.when(holds, SUCCESS).otherwise(FAILED))


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count of each table, one row per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
