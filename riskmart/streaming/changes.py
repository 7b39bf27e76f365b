"""Idempotent consumption of a change feed with Structured Streaming.

Each micro-batch appends only changes whose key (consumer, LSN, sequence, op) is
not stored yet, so a replay adds nothing. The watermark is a record of how far a
consumer got; correctness never rests on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskmart.sources.tables import read_or_empty

CHANGE_KEY = ("lsn", "seq", "op")
CONSUMED_SCHEMA = "consumer string, run_id bigint, lsn bigint, seq bigint, op int, consumed_at timestamp"
WATERMARK_SCHEMA = "consumer string, lsn bigint, seq bigint, updated_at timestamp"
EXPECTED_OPS = {2: 2, 3: 1, 4: 1}


def read_consumed(spark: SparkSession, root: str) -> DataFrame:
    """Stored changes; empty before the first batch."""
    return read_or_empty(spark, f"{root}/changes", CONSUMED_SCHEMA)


def read_watermarks(spark: SparkSession, root: str) -> DataFrame:
    """Current watermark per consumer. Watermark rows are only appended."""
    return watermarks(read_or_empty(spark, f"{root}/watermarks", WATERMARK_SCHEMA))


def unconsumed(changes: DataFrame, consumed: DataFrame, consumer: str) -> DataFrame:
    """Changes the consumer has not stored; repeats inside the input count once."""
    known = consumed.where(F.col("consumer") == consumer).select(*CHANGE_KEY)
    return changes.dropDuplicates(list(CHANGE_KEY)).join(known, list(CHANGE_KEY), "left_anti")


def watermarks(changes: DataFrame, keys: tuple[str, ...] = ("consumer",)) -> DataFrame:
    """Last LSN per consumer, by LSN then sequence."""
    return changes.groupBy(*keys).agg(F.max("lsn").alias("last_lsn"), F.max_by("seq", F.struct("lsn", "seq")).alias("last_seq"))


def op_counts(changes: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    return changes.groupBy(*keys, "op").agg(F.count("*").alias("changes"))


def expected_ops_present(changes: DataFrame, expected: dict[int, int] = EXPECTED_OPS) -> DataFrame:
    """Whether each run shows every expected op as often as it should."""
    met = None
    for op, count in expected.items():
        term = F.count_if(F.col("op") == op) == count
        met = term if met is None else met & term
    return changes.groupBy("run_id").agg(met.alias("complete"))


def ordered(changes: DataFrame) -> DataFrame:
    return changes.orderBy("lsn", "seq", "op")


def consume_batch(changes: DataFrame, root: str, consumer: str) -> None:
    """Appends the new changes of one micro-batch, then the watermark it reached.

    Only stored changes from the batch's own lowest LSN on can collide with it,
    so older history is pruned from the comparison.
    """
    spark = changes.sparkSession
    lowest = changes.agg(F.min("lsn")).first()[0]
    if lowest is None:
        return
    fresh = unconsumed(changes, read_consumed(spark, root).where(F.col("lsn") >= lowest), consumer)
    name = F.lit(consumer).alias("consumer")
    fresh.select(
        name, "run_id", "lsn", "seq", F.col("op").cast("int").alias("op"), F.current_timestamp().alias("consumed_at")
    ).write.mode("append").parquet(f"{root}/changes")
    reached = watermarks(changes.select(name, "lsn", "seq"))
    reached.select(
        "consumer", F.col("last_lsn").alias("lsn"), F.col("last_seq").alias("seq"), F.current_timestamp().alias("updated_at")
    ).write.mode("append").parquet(f"{root}/watermarks")


def start_consumer(spark: SparkSession, feed: str, schema: str, root: str, checkpoint: str, consumer: str) -> StreamingQuery:
    """Consumes everything the feed folder holds, then stops (``availableNow``)."""
    changes = spark.readStream.schema(schema).parquet(feed)
    return (
        changes.writeStream.foreachBatch(lambda df, _: consume_batch(df, root, consumer))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
