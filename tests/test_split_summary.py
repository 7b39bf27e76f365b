"""The split summary counts every record group, whatever the training population leaves out."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskmart.functions.hashing import packed, unpacked
from riskmart.operators import ml as L
from riskmart.operators.ranks import derived_hash_rank, hash_rank
from riskmart.plans.fixtures import Sources
from riskmart.plans.ml_queries import ml_split_summary

from conftest import rows
from test_ml_and_streaming import population

FOLDER = "/root/testdata/sf0.001"


def grouped_summary(data):
    return L.split_summary(L.assign_splits(L.record_groups(data), grouped=True), L.GROUP_ROWS, (L.SLICE,))


def test_no_group_is_left_out_beyond_the_quotas(spark, monkeypatch):
    monkeypatch.setattr(L.bounded_population, "__defaults__", (7, 20))
    src = Sources(spark, FOLDER)
    found = ml_split_summary(src).agg(*[F.sum(c).alias(c) for c in ("rows", "positive_rows", "negative_rows", "distinct_groups")]).first()
    fact = src.fact_risk.agg(F.count("*"), F.sum("has_claim"), F.count_if(F.col("has_claim") == 0), F.count_distinct("record_hash")).first()
    assert tuple(found) == tuple(fact) and found.distinct_groups > 27


@pytest.mark.parametrize("name", ["record_hash", "concat('group ', source_row_number div 1000)", "lower(substring(record_hash, 1, 9))"])
def test_summary_of_counted_groups_equals_brute_force(spark, name):
    """A hot group, and groups with both labels; any text may serve as a hash."""
    data = population(spark).withColumn("record_hash", F.expr(name))
    data = data.withColumn("has_claim", F.when(F.col("source_row_number") % 3_000 == 1_001, 1).otherwise(F.col("has_claim")))
    loose = data.limit(3).withColumn("record_hash", F.lit(None).cast("string")).unionByName(data.limit(2).withColumn("has_claim", F.lit(None).cast("int")))
    counts = defaultdict(int)
    for r in data.collect():
        counts[r.record_hash, r.has_claim] += 1
    split = {}
    for label in (0, 1):
        ranked = sorted((g for g, y in counts if y == label), key=lambda g: (hashlib.sha256(f"{g}:{L.SEED}".encode()).hexdigest(), g))
        split |= {(g, label): ("test", "validation", "train", "train", "train")[i % 5] for i, g in enumerate(ranked)}
    want = []
    for part in ("test", "train", "validation"):
        n = [sum(c for (g, y), c in counts.items() if split[g, y] == part and y == label) for label in (0, 1)]
        groups = len({g for (g, y) in counts if split[g, y] == part})
        want.append((part, sum(n), n[1], n[0], round(n[1] / sum(n), 9), groups, sum(n) - groups))
    assert any((g, 0) in counts and (g, 1) in counts for g, _ in counts)
    assert rows(grouped_summary(data.unionByName(loose))) == rows(L.split_summary(L.assign_splits(data))) == want


def test_groups_move_once_for_ranks_and_summary(spark):
    groups = L.stored(L.record_groups(population(spark)), "test-groups")
    plan = L.split_summary(L.assign_splits(groups, grouped=True), L.GROUP_ROWS, (L.SLICE,))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2 and "hashpartitioning(split" in dealt[0] and "hashpartitioning(_slice" in dealt[1] and "SortMergeJoin" not in plan


def test_derived_rank_equals_rank_by_a_column(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("k"))
    order = F.upper(F.sha2(F.col("k"), 256))
    by_column = hash_rank(df.withColumn("h", order), "h", ("g",)).select("g", "k", "hash_rank")
    assert rows(derived_hash_rank(df, order, ("g",), as_bytes=("k",)), "g", "k", "hash_rank") == rows(by_column)


def test_packed_texts_come_back(spark):
    texts = ["", "AB", "ab", "ABC", "0ABC", "A" * 64, "group 1", "\x00", "\x01AB", "é", "4142", "«", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("p", packed(F.col("t")))
    got = {r.i: (r.back, r.n) for r in df.select("i", unpacked(F.col("p")).alias("back"), F.octet_length("p").alias("n")).collect()}
    assert [got[i][0] for i in range(len(texts))] == texts and got[5][1] == 33
    assert df.where("p is not null").select("p").distinct().count() == len(texts) - 1
