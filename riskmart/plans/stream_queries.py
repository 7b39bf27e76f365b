"""The change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.plans.fixtures import Sources
from riskmart.plans.registry import query
from riskmart.sources.tables import new_folder
from riskmart.streaming import changes as S

FEED_SCHEMA = "run_id bigint, record_id bigint, lsn bigint, seq bigint, op int"
CONSUMER = "feed-consumer"


@query(
    "cdc_consume",
    f"SELECT '{CONSUMER}' AS consumer, run_id, lsn, seq, CAST(op AS INT) AS op FROM fx_changes",
)
def cdc_consume(src: Sources) -> DataFrame:
    """The feed consumed twice, the second time from a fresh checkpoint: nothing is added."""
    root = new_folder(src.spark, "cdc")
    src.changes.select(*[c.split()[0] for c in FEED_SCHEMA.split(", ")]).write.parquet(f"{root}/feed")
    for attempt in ("first", "replay"):
        S.start_consumer(
            src.spark, f"{root}/feed", FEED_SCHEMA, f"{root}/consumed", f"{root}/checkpoint-{attempt}", CONSUMER
        ).awaitTermination()
    return S.read_consumed(src.spark, f"{root}/consumed").select("consumer", "run_id", "lsn", "seq", "op")


@query(
    "cdc_watermark",
    "SELECT run_id, max(lsn) AS last_lsn, arg_max(seq, lsn * 1000000 + seq) AS last_seq FROM fx_changes GROUP BY 1",
)
def cdc_watermark(src: Sources) -> DataFrame:
    return S.watermarks(src.changes, ("run_id",))


@query("cdc_op_counts", "SELECT run_id, CAST(op AS INT) AS op, count(*) AS changes FROM fx_changes GROUP BY 1, 2")
def cdc_op_counts(src: Sources) -> DataFrame:
    return S.op_counts(src.changes)


@query("cdc_changes", "SELECT run_id, record_id, lsn, seq, CAST(op AS INT) AS op FROM fx_changes ORDER BY lsn, seq, op")
def cdc_changes(src: Sources) -> DataFrame:
    return S.ordered(src.changes.withColumn("op", F.col("op").cast("int")))
