import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.operators import ml as L
from riskmart.operators import sgd
from riskmart.plans import scoring
from riskmart.plans import training as T

from test_ml_and_streaming import population


def test_sgd_learns_the_logistic_model(spark):
    """Labels drawn from known weights: probabilities come close, and another split of the rows gives about the same."""
    draw = np.random.default_rng(1)
    x, y = draw.integers(0, 3, 4000), draw.integers(0, 2, 4000)
    p = 1 / (1 + np.exp(-(np.array([-2.0, 0.0, 1.5])[x] + np.array([0.5, -0.5])[y])))
    rows = [(int(a), None if b else "b", int(draw.random() < q)) for a, b, q in zip(x, y, p, strict=True)]
    df = spark.createDataFrame(rows, "x int, y string, label int")
    for partitions in (1, 4):
        weights = sgd.fit(df, "label", ("x", "y"), partitions=partitions)
        got = {(r.x, r.y): r.probability for r in sgd.with_probability(df, weights, ("x", "y")).select("x", "y", "probability").distinct().collect()}
        want = {(int(a), None if b else "b"): q for a, b, q in zip(x, y, p, strict=True)}
        assert max(abs(got[k] - want[k]) for k in want) < 0.06
    unseen = sgd.with_probability(spark.createDataFrame([(9, "zz")], "x int, y string"), weights, ("x", "y")).first().probability
    assert abs(unseen - 1 / (1 + np.exp(-weights.where("feature is null").first().weight))) < 1e-12


def test_sgd_bounds_its_weights(spark, monkeypatch):
    monkeypatch.setattr(sgd, "MOST_WEIGHTS", 5)
    with pytest.raises(sgd.TooManyCategoriesError):
        sgd.fit(spark.range(10).select("id", F.lit(1).alias("label")), "label", ("id",))


@pytest.mark.parametrize("nulls", ["mode", "category"])
def test_sgd_model_null_policies_and_reload(spark, tmp_path, nulls):
    data = population(spark, 100)
    model = L.SgdModel.fit(data, nulls)
    kinds = {r.feature for r in model.weights.where("value is null and feature is not null").collect()}
    assert kinds == ({"gender"} if nulls == "category" else set())
    model.save(str(tmp_path), {"selected_model": "sgd_logistic"})
    again = L.load_model(spark, str(tmp_path))
    assert again.nulls == nulls and model.score(data).exceptAll(again.score(data)).count() == 0 and model.score(data).count() == data.count()


def test_training_job_then_scoring_job(spark, tmp_path):
    splits = L.assign_splits(population(spark, 300))
    path = str(tmp_path / "model")
    done = T.train_claim_model(spark, splits, path, "m1", caps=(200, 400))
    assert [p["cap"] for p in done.progress] == [200, 400] and done.progress[0]["training_rows"] < done.progress[1]["training_rows"]
    assert {c["model"] for c in done.candidates} == set(L.MODELS) and done.selected_model in L.MODELS
    assert done.metadata.items() <= L.model_metadata(spark, path).items()
    assert done.test["rows"] == splits.where("split = 'test'").count() == int(done.metadata["test_rows"])
    result = scoring.score_population(spark, str(tmp_path / "predictions"), path, splits.where("split = 'test'"), "held_out", "m1", buckets=4)
    assert result.stored_rows == done.test["rows"]


def test_training_job_refuses_bad_populations_and_models(spark, tmp_path, monkeypatch):
    data = population(spark, 60)
    leaky = data.withColumn("split", F.when(F.col("source_row_number") % 2 == 0, "train").otherwise("test"))
    with pytest.raises(L.PopulationError, match="more than one split"):
        T.train_claim_model(spark, leaky, str(tmp_path), "m", caps=(100,))
    monkeypatch.setattr(L, "load_model", lambda spark, path: L.ClaimModel.fit(data.withColumn("has_claim", 1 - F.col("has_claim")), "bayes"))
    with pytest.raises(T.ReloadError):
        T.train_claim_model(spark, L.assign_splits(data), str(tmp_path / "m"), "m", caps=(100,))
