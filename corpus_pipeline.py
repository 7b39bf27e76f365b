"""Corpus pipeline: quality, near duplicates, benchmark decontamination, mixture, shards.

Each stage takes what the one before it kept, written as Parquet and read again. All but the last return the columns of ``documents``; the last
returns the place of every remaining document (see ``riskmart.llm.sharding``).

Defined cases of every stage: an empty table gives an empty one; columns beside those of ``documents`` are carried by all stages but the last, whatever
their names; very long texts are judged whole. Ids may be missing or repeated: the second and third stage number the rows they are given, in a written
table, and judge each row by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import decontamination, mixing, near_dedup, quality_model, sharding
from riskmart.llm.common import Store, table, without

#: What near copies are in a corpus: five-word shingles, at least 80 of 100 in common.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def numbered(docs: DataFrame, store: Store) -> tuple[DataFrame, str]:
    """The rows with a number each, written so that a number stays with its row, and the number's column: a name that no other column has."""
    key = "row_key"
    while key.lower() in {c.lower() for c in docs.columns}:
        key += "_"
    return store.put(docs.withColumn(key, F.monotonically_increasing_id()), "numbered"), key


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.5) go. Null and empty texts are scored like any other; of rows that share an id each
    has a score of its own."""
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component stays: that of the smallest id (rows without an id come last), of equal ids the first row. Rows without
    words are no copies of each other; different texts under one id all stay."""
    work = Store(spark, "copies-work")
    rows, key = numbered(docs, work)
    found = near_dedup.near_duplicates(rows.select(key, "text"), SHINGLE_WORDS, SIMILAR_PERCENT, id_col=key, store=work)
    placed = work.put(found.join(rows.select(key, "doc_id"), key).select(key, "doc_id", "component_id"), "placed")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    best = placed.groupBy("component_id").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("component_id", F.col(f"best.{key}").alias("stays"))
    gone = work.put(placed.join(best, "component_id").where(F.col(key) != F.col("stays")).select(F.col(key).alias("gone")), "gone")
    return kept_rows(rows, gone, key, work)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows contaminated by exact benchmark passages go, with or without an id; proximity matches alone do not condemn. An empty benchmark, or items
    without words, condemn none."""
    work = Store(spark, "contaminated-work")
    rows, key = numbered(docs, work)
    found = decontamination.contamination(rows.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"), misses=0, store=work)
    gone = work.put(found.where("contaminated").select(F.col("doc_id").alias("gone")), "gone")
    return kept_rows(rows, gone, key, work)


def kept_rows(rows: DataFrame, gone: DataFrame, key: str, work: Store) -> DataFrame:
    """The rows that stay, with the columns they came with. What the verdict no longer needs is deleted before the next stage starts."""
    work.keep("numbered", "gone")
    return without(rows, gone, key).drop(key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by calibrated probabilities towards the source, language and topic targets. Missing sources and languages are values of
    their own; rows with one id are sampled alike; documents without words are never taken."""
    return mixing.mix(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row's shard and slot, rows with missing or repeated ids and null texts included."""
    return sharding.shards(docs)


STAGES = [
    ("quality_model", accept_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]
#: The first stage is a trained model, so no SQL gives these rows; tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, docs = Store(spark, "pipeline"), table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = store.put(stage(spark, docs, sf_dir), f"{number}-{name}")
        if number > 1:
            store.drop(f"{number - 1}-{STAGES[number - 1][0]}")
    return docs
