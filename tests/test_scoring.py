import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskmart.operators import ml as L
from riskmart.plans import scoring as J
from riskmart.sources.keyed_table import DuplicateKeyError, KeyedTable, StateChangedError

from test_ml_and_streaming import population

SCHEMA = "k string, n bigint, v string"


def files_of(table, state):
    return {e.bucket: sorted((f, open(os.path.join(folder, f), "rb").read()) for f in os.listdir(folder) if f.endswith(".parquet"))
            for e in table.manifest(state) for folder in [f"{table.root}/data/{e.generation}/bucket={e.bucket}"]}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ("k", "n"), SCHEMA, buckets=8)
    assert table.read().count() == 0 and table.state() == 0
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = [(f"k{i % 5}", i, "old") for i in range(200)]
    assert table.upsert(make(first)) == 1
    assert sorted(map(tuple, table.read().collect())) == sorted(first)
    before = files_of(table, 1)
    change = [("k3", 3, "new"), ("k9", 1000, None)]
    assert table.upsert(make(change)) == 2
    want = {(k, n): v for k, n, v in first} | {(k, n): v for k, n, v in change}
    assert {(r.k, r.n): r.v for r in table.read().collect()} == want and table.read().count() == len(want)
    after = files_of(table, 2)
    touched = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(touched) <= 2 and len(after) == 8 and all(after[b] == before[b] for b in set(after) - touched)
    # The earlier state can still be read, until it is vacuumed.
    assert sorted(map(tuple, table.read(1).collect())) == sorted(first)
    assert table.upsert(make([])) == 3 and table.read().count() == len(want)
    assert table.vacuum(keep=1) == 0 and table.upsert(make(first)) == 4 and table.vacuum(keep=1) == 2
    assert table.read().count() == len(want)


def test_duplicates_nulls_and_other_writers_raise(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), ("k", "n"), SCHEMA, buckets=4)
    table.upsert(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    for bad in ([("b", 1, "x"), ("b", 1, "y")], [(None, 1, "x")]):
        with pytest.raises(DuplicateKeyError):
            table.upsert(spark.createDataFrame(bad, SCHEMA))
    assert table.state() == 1 and len(os.listdir(tmp_path / "data")) == 1
    states = iter([1, 2])
    monkeypatch.setattr(table, "state", lambda: next(states))
    with pytest.raises(StateChangedError):
        table.upsert(spark.createDataFrame([("c", 1, "z")], SCHEMA))
    monkeypatch.undo()
    assert [r.k for r in table.read().collect()] == ["a"] and table.vacuum(keep=1) == 1


def test_scoring_job_runs_twice(spark, tmp_path):
    data, root, model = population(spark, 60), str(tmp_path / "predictions"), str(tmp_path / "model")
    L.ClaimModel.fit(data, "bayes").save(model, {"model_version": "m1"})
    test = data.where("source_row_number % 2 = 0")
    score = lambda rows, **more: J.score_population(spark, root, model, rows, "held_out", "m1", buckets=4, **more)
    first = score(test, run_id="r1")
    assert first.stored_rows == first.expected_rows == first.predicted_rows == test.count() and first.duplicate_identities == 0
    again = score(test, run_id="r2")
    stored = J.prediction_table(spark, root, 4).read()
    assert again.stored_rows == first.stored_rows == stored.count() and [r.run_id for r in stored.select("run_id").distinct().collect()] == ["r2"]
    # Another version of the file is another identity; the reconciliation then finds rows that were not asked for.
    other = test.withColumn("source_version", F.lit("w"))
    with pytest.raises(L.PredictionError, match="unexpected_identities"):
        score(other)
    with pytest.raises(DuplicateKeyError):
        score(test.unionByName(test.limit(1)))
    with pytest.raises(J.ScoringError, match="m1"):
        J.score_population(spark, root, model, test, "held_out", "m2")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_deals_rows_once_and_keeps_texts_that_are_no_hex(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ("k", "n"), SCHEMA, buckets=4, hex_columns=("v",))
    texts = ["00FF", "ab", "ABC", "", None, "no hex", "DEADBEEF"]
    first = [("a", i, texts[i % 7]) for i in range(70)]
    table.upsert(spark.createDataFrame(first, SCHEMA))
    change = [("a", i, texts[(i + 1) % 7]) for i in range(60, 100)]
    incoming = spark.createDataFrame(change, SCHEMA)
    merged = table._merged(table.read(), incoming, Observation())
    assert plan(merged).count("Exchange ") == plan(merged).count("Exchange rangepartitioning") == 1 and "Join" not in plan(merged)
    table.upsert(incoming)
    want = {r[:2]: r[2] for r in first} | {r[:2]: r[2] for r in change}
    assert {(r.k, r.n): r.v for r in table.read().collect()} == want and table.read().count() == 100
    with pytest.raises(DuplicateKeyError, match="2 rows with key"):
        table.upsert(incoming.union(incoming.where("n = 77")))
    assert table.read().count() == 100 and len(os.listdir(tmp_path / "data")) == 2
    assert all(f.endswith(".zstd.parquet") for _, _, names in os.walk(tmp_path / "data") for f in names if f.endswith(".parquet"))


def test_rows_that_differ_when_read_again_are_not_published(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), ("k", "n"), SCHEMA, buckets=8)
    table.upsert(spark.createDataFrame([("a", i, "old") for i in range(50)], SCHEMA))
    merged = table._merged
    other = spark.createDataFrame([("a", i, "new") for i in range(50)], SCHEMA)
    monkeypatch.setattr(table, "_merged", lambda stored, rows, bad: merged(stored, other, bad))
    with pytest.raises(StateChangedError):
        table.upsert(spark.createDataFrame([("a", 1, "new")], SCHEMA))
    assert table.state() == 1 and {r.v for r in table.read().collect()} == {"old"}


def test_cases_are_reconciled_in_one_pass(spark):
    make = lambda numbers: spark.createDataFrame([("f", "v", i) for i in numbers], "source_file string, source_version string, source_row_number long")
    stored, expected = make(range(40)), make(range(2, 42))
    number = F.col("source_row_number")
    copies = {"all": F.lit(1), "odd": (number % 2).cast("int"), "twice": F.lit(1) + (number % 10 == 3).cast("int")}
    together = L.prediction_reconciliation(stored, expected, copies)
    assert plan(together).count("Exchange hashpartitioning") == 1
    apart = {"all": stored, "odd": stored.where("source_row_number % 2 = 1"), "twice": stored.union(stored.where("source_row_number % 10 = 3"))}
    want = [(case, *L.prediction_reconciliation(df, expected).first()) for case, df in apart.items()]
    assert [tuple(r) for r in together.collect()] == want and want[2][1:4] == (44, 40, 4)
