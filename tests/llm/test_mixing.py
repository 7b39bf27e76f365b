import pytest
from pyspark.sql import functions as F

from riskmart.llm import mixing as M


def documents(spark):
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"s{i // 12 % 4}"
        lang = ("en", "de", "fr", None)[(i // 3) % 4 if i % 5 else 0]
        text = None if i % 101 == 0 else "" if i % 103 == 0 else ("Licensed under X " if i % 7 == 0 else "") + "word " * (1 + i % 13)
        rows.append((i, text, source, lang, i, f"t{i}"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, selected int, topic string")


def test_marginals_and_budget(spark):
    rows = M.probabilities(documents(spark), temper=0.5).toPandas()
    tokens, raked = rows.n_tokens.sum(), rows.n_tokens * rows.factor
    for d in ("source", "lang", "topic"):
        own = rows.fillna("?").groupby(d).n_tokens.sum() ** 0.5
        have = raked.groupby(rows[d].fillna("?")).sum()
        for value, share in (own / own.sum()).items():
            assert have[value] / tokens == pytest.approx(share, abs=2e-3), (d, value)
    assert (rows.n_tokens * rows.probability).sum() == pytest.approx(M.BUDGET * tokens, rel=1e-6)
    assert rows.probability.between(0, 1).all() and set(rows[rows.probability == 1].selected) <= {True}
    assert rows[rows.selected].n_tokens.sum() == pytest.approx(M.BUDGET * tokens, rel=0.08)
    assert rows.source.isna().sum() > 0 and rows.lang.isna().sum() > 0 and len(rows) == 900


def test_explicit_shares(spark):
    rows = M.probabilities(documents(spark), shares={"source": {"hot": 0.1, "s0": 0.3, "s1": 0.3, "s3": 0.3}}, rounds=30).toPandas()
    raked = rows.n_tokens * rows.factor
    assert raked[rows.source == "hot"].sum() / raked.sum() == pytest.approx(0.1, abs=1e-2)
    assert not rows[rows.source == "s2"].selected.any()


def test_mix_keeps_columns(spark):
    df = documents(spark)
    mixed = M.mix(df)
    assert mixed.columns == df.columns
    wanted = {r.doc_id for r in M.probabilities(df).where("selected").collect()}
    assert {r.doc_id for r in mixed.collect()} == wanted and 0 < len(wanted) < 900
    assert mixed.join(df, df.columns, "left_anti").where("text is not null and source is not null and lang is not null").count() == 0
    twice = M.mix(df.union(df)).groupBy("doc_id").agg(F.count("*").alias("n"))
    assert {r.n for r in twice.collect()} == {2}


def test_empty_and_blank(spark):
    df = documents(spark)
    assert M.mix(df.where("false")).count() == 0 and M.probabilities(df.where("false")).count() == 0
    blank = M.probabilities(df.withColumn("text", F.lit("  "))).toPandas()
    assert len(blank) == 900 and not blank.selected.any() and (blank.factor == 0).all()


def test_few_cells_are_raked_without_exchange_or_broadcast(spark, monkeypatch):
    cells = spark.createDataFrame([(f"s{i % 7}", f"l{i % 3}", f"t{i % 5}", 1.0 + i % 11, 3.0, 5.0, 4.0) for i in range(105)],
                                  "source string, lang string, topic string, weight double, target_source double, target_lang double, target_topic double").repartition(4)
    once = M.raked_once(cells, True)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Broadcast" not in plan
    want = {r[:3]: r.weight for r in M.raked_once(cells, False).select("source", "lang", "topic", "weight").collect()}
    assert {r[:3]: r.weight for r in once.select("source", "lang", "topic", "weight").collect()} == pytest.approx(want) and len(want) == 105
    df = documents(spark)
    few = M.probabilities(df).toPandas().set_index("doc_id")
    monkeypatch.setattr(M, "LOCAL_CELLS", 0)
    many = M.probabilities(df).toPandas().set_index("doc_id").loc[few.index]
    assert (few.probability - many.probability).abs().max() < 1e-7 and (few.selected == many.selected).all()
