import random

import numpy as np
from pyspark.sql import functions as F

from riskmart.operators import ml as L
from riskmart.operators import profiling as R
from riskmart.operators.ranks import hash_rank, running_totals, slice_by_bounds

from conftest import rows


def test_hash_rank_equals_one_global_order(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    ranked = hash_rank(df, "h", ("g",), digits=2).collect()
    for g in range(3):
        ordered = sorted(r.h for r in ranked if r.g == g)
        assert {r.h: r.hash_rank for r in ranked if r.g == g} == {h: i + 1 for i, h in enumerate(ordered)}


def test_running_totals_both_directions(spark):
    values = list(range(100))
    df = spark.createDataFrame([(v, v * 2) for v in values], "k int, n long")
    slices = slice_by_bounds(F.col("k"), [10, 10.5, 55])
    up = dict(rows(running_totals(df, "k", slices, ("n",)), "k", "cum_n"))
    down = dict(rows(running_totals(df, "k", slices, ("n",), descending=True), "k", "cum_n"))
    assert up == {v: sum(2 * x for x in values if x <= v) for v in values}
    assert down == {v: sum(2 * x for x in values if x >= v) for v in values}


def test_quantiles_match_numpy_with_a_hot_value(spark):
    rng = random.Random(3)
    data = [(7.0 if rng.random() < 0.4 else rng.gauss(0, 50), float(rng.randint(0, 3)), None if i % 2 else float(i)) for i in range(3001)]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(5)
    got = {(r.column_name, r.level): r.value for r in R.exact_quantiles(df, ("a", "b", "c"), slices=8).collect()}
    for at, name in enumerate("abc"):
        values = [row[at] for row in data if row[at] is not None]
        for level in R.QUANTILES:
            assert abs(got[(name, level)] - np.quantile(values, level)) < 1e-9


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total, ap, last = sum(y for _, y in pairs), 0.0, 0.0
    for threshold in sorted({s for s, _ in pairs}, reverse=True):
        chosen = [y for s, y in pairs if s >= threshold]
        recall = sum(chosen) / total
        ap += (recall - last) * sum(chosen) / len(chosen)
        last = recall
    return ap


def test_ranking_metrics_match_brute_force(spark):
    rng = random.Random(11)
    pairs = [(round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), 2), y) for y in (int(rng.random() < 0.3) for _ in range(400))]
    df = spark.createDataFrame(pairs, "score double, has_claim int").withColumn("score", F.col("score").cast("decimal(12,10)"))
    row = L.ranking_metrics(df).first()
    assert abs(row.roc_auc - brute_auc(pairs)) < 1e-12
    assert abs(row.average_precision - brute_ap(pairs)) < 1e-12
    matrix = L.confusion(df).first()
    assert matrix.tp == sum(1 for s, y in pairs if s >= 0.5 and y)
    assert matrix.tp + matrix.fp + matrix.fn + matrix.tn == 400
