import hashlib

import pytest
from pyspark.sql import functions as F

from riskmart.operators import ml as L
from riskmart.operators import profiling as R
from riskmart.streaming import changes as S

from conftest import rows


def population(spark, groups=300):
    """Groups of one to three rows; one group holds a third of all rows."""
    base = spark.range(groups).select(F.col("id").alias("g"), F.explode(F.sequence(F.lit(0), F.when(F.col("id") == 0, 299).otherwise(F.col("id") % 3))).alias("k"))
    return base.select(
        F.lit("a.csv").alias("source_file"),
        F.lit("v").alias("source_version"),
        (F.col("g") * 1000 + F.col("k")).alias("source_row_number"),
        F.upper(F.sha2(F.col("g").cast("string"), 256)).alias("record_hash"),
        F.when(F.col("g") % 5 == 0, 1).otherwise(0).alias("has_claim"),
        F.when(F.col("g") % 5 == 0, "M").when(F.col("g") % 7 != 0, "F").alias("gender"),
        *[(F.col("g") % m).cast("string").alias(c) for m, c in ((3, "driv_age"), (4, "veh_model"), (2, "veh_group"), (6, "area"), (6, "state_ab"))],
        (F.col("g") % 9 + 2000).cast("int").alias("veh_year"),
    )


def test_bounded_population_keeps_whole_groups(spark):
    data = population(spark)
    kept = L.bounded_population(data, 7, 20)
    groups = {(hashlib.sha256(str(g).encode()).hexdigest().upper(), int(g % 5 == 0)) for g in range(300)}
    wanted = {h for label, n in ((1, 7), (0, 20)) for h in sorted(h for h, y in groups if y == label)[:n]}
    assert {r[0] for r in kept.select("record_hash").distinct().collect()} == wanted
    assert kept.count() == data.where(F.col("record_hash").isin(list(wanted))).count()
    L.require_population(kept)
    with pytest.raises(L.PopulationError):
        L.require_population(kept.limit(0))


def test_splits_are_isolated_and_stratified(spark):
    split = L.assign_splits(population(spark))
    assert split.count() == population(spark).count() and L.split_leaks(split).count() == 0
    counts = {(r.split, r.has_claim): r.n for r in split.groupBy("split", "has_claim").agg(F.count_distinct("record_hash").alias("n")).collect()}
    assert counts == {("test", 1): 12, ("validation", 1): 12, ("train", 1): 36, ("test", 0): 48, ("validation", 0): 48, ("train", 0): 144}
    capped = L.stratified_cap(split, split.count() // 2)
    assert capped.select("record_hash").distinct().count() == 150
    assert L.stratified_cap(split, 10**9).count() == split.count()


@pytest.mark.parametrize("kind", ["logistic", "bayes"])
def test_model_survives_a_reload(spark, tmp_path, kind):
    data = population(spark)
    model = L.ClaimModel.fit(data, kind)
    model.save(str(tmp_path / kind))
    again = L.ClaimModel.load(str(tmp_path / kind))
    unseen = data.withColumn("veh_model", F.lit("never seen"))
    for frame in (data, unseen):
        assert model.score(frame).exceptAll(again.score(frame)).count() == 0
    assert model.score(data).count() == data.count()
    if kind == "logistic":
        # Gender tells the labels apart wherever it is known; elsewhere the mode stands in.
        known = L.evaluate(model, data.where("gender IS NOT NULL"), kind).first()
        assert known.roc_auc > 0.99


def test_partition_duplicates_with_a_hot_record(spark):
    data = [("a", "hot")] * 40 + [("b", "hot")] * 30 + [("b", "x"), ("c", "x"), ("c", "y")]
    df = spark.createDataFrame(data, "source_file string, record string")
    assert rows(R.partition_duplicates(df, "record")) == [("a", 40, 39), ("b", 31, 30), ("c", 2, 1)]


def test_matrix_shape_policies(spark):
    train = spark.createDataFrame([("a", "x"), ("b", None)], "p string, q string")
    frame = spark.createDataFrame([("a", None), ("z", "x"), (None, "x")], "p string, q string")
    mode = L.matrix_shape(train, frame, ("p", "q")).first()
    assert (mode.rows, mode.columns, mode.nonzero_values) == (3, 3, 5)
    category = L.matrix_shape(train, frame, ("p", "q"), null_policy="category").first()
    assert (category.rows, category.columns, category.nonzero_values) == (3, 4, 4)


FEED = "run_id bigint, record_id bigint, lsn bigint, seq bigint, op int"


def test_replayed_changes_add_nothing(spark, tmp_path):
    feed, root = str(tmp_path / "feed"), str(tmp_path / "consumed")
    ops = [(1, 1, 10, 1, 2), (1, 1, 11, 2, 3), (1, 1, 11, 2, 4), (1, 2, 12, 3, 2)]
    spark.createDataFrame(ops, FEED).write.parquet(feed)

    def consume(checkpoint, consumer="c1"):
        S.start_consumer(spark, feed, FEED, root, str(tmp_path / checkpoint), consumer).awaitTermination()
        return S.read_consumed(spark, root).where(F.col("consumer") == consumer).count()

    assert consume("k1") == 4 and consume("k1") == 4 and consume("k2") == 4
    assert consume("k3", "c2") == 4
    spark.createDataFrame([(1, 3, 13, 4, 2), ops[0]], FEED).write.mode("append").parquet(feed)
    assert consume("k1") == 5
    marks = {r.consumer: (r.last_lsn, r.last_seq) for r in S.read_watermarks(spark, root).collect()}
    assert marks == {"c1": (13, 4), "c2": (12, 3)}
    assert S.expected_ops_present(spark.createDataFrame(ops, FEED)).first().complete
    assert rows(S.op_counts(spark.createDataFrame(ops, FEED))) == [(1, 2, 2), (1, 3, 1), (1, 4, 1)]
