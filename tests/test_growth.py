"""Steps whose shuffles grew faster than the input: what they shuffle and how they join, read from plans."""

import os

from pyspark.sql import functions as F

from riskmart.operators import marts as M
from riskmart.operators import ml as L
from riskmart.plans.fixtures import sources
from riskmart.sources.tables import write_table

from conftest import rows

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def copies(spark, name):
    """300 groups of 40 rows, every fifth group with label 1."""
    base = spark.range(12_000).withColumn("g", F.col("id") % 300)
    return base.select(F.expr(name).alias("record_hash"), (F.col("g") % 5 == 0).cast("int").alias("has_claim"), "id")


def test_population_of_many_copies_shuffles_no_rows(spark):
    for name in ("upper(sha2(cast(g as string), 256))", "concat('group ', g)"):
        data = copies(spark, name)
        hashes = {(r[0], r[1]) for r in data.select("record_hash", "has_claim").distinct().collect()}
        for quotas in ((7, 20), (60, 5), (1000, 1000)):
            wanted = {h for label, n in zip((1, 0), quotas, strict=True) for h in sorted(h for h, y in hashes if y == label)[:n]}
            kept = L.bounded_population(data, *quotas)
            assert "hashpartitioning" not in plan(kept)
            assert {r[0] for r in kept.select("record_hash").distinct().collect()} == wanted
            assert kept.count() == 40 * len(wanted)


def test_splits_and_caps_shuffle_no_rows(spark):
    split = L.assign_splits(copies(spark, "upper(sha2(cast(g as string), 256))"))
    assert "hashpartitioning" not in plan(split) and split.count() == 12_000
    capped = L.stratified_cap(split, 6_000)
    assert "hashpartitioning" not in plan(capped) and capped.count() == 6_000


def test_batches_are_a_stored_table(spark):
    batches = sources(spark, FOLDER).market_batches
    assert "Aggregate" not in plan(batches) and "Exchange" not in plan(batches)


def test_lines_are_neither_sorted_nor_joined_to_customers(spark):
    src = sources(spark, FOLDER)
    for df in (src._market(), src._risk(), M.score_bands(src.scores, src.fact_risk, src.risk_dims)):
        assert "ShuffledHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)
    assert "record_hash" not in src._market().columns + src._risk().columns
    assert "record_hash" in src.market.columns and src.risk.columns[0] == "record_hash"


def test_hashes_travel_as_bytes_and_come_back(spark, tmp_path):
    data = spark.range(50).select((F.col("id") % 3).alias("year"), "id", F.upper(F.sha2(F.col("id").cast("string"), 256)).alias("h"))
    stored = write_table(data, str(tmp_path / "t"), partition_by=("year",), sort_by=("id",), hex_columns=("h",))
    assert rows(stored, *data.columns) == rows(data)
    files = [f for _, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
