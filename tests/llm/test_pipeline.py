import random
from pathlib import Path

import corpus_pipeline as P
import duckdb
import pandas as pd
import pytest
from riskmart.llm import quality_model
from riskmart.llm.common import Store
from riskmart.llm.queries import OP4_SQL
from test_decontamination import brute as contamination_of
from test_near_dedup import brute as components_of
from test_sharding import brute as shards_of

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(P.STAGES)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def documents():
    """Copies around four fifths, exact copies, missing and repeated ids, passages of the benchmark, blank and long texts."""
    draw = random.Random(21)
    vocabulary = [f"word{i}" for i in range(900)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([5, 13, 30])))) for i in range(12)] + [(50, None), (51, "..")]
    rows = [(1, None), (2, ""), (None, None), (3, " \n "), (None, "lonely words of no other row at all"), (4, "four short words only")]
    for f in range(8):
        base = draw.choices(vocabulary, k=120)
        for k in range(9):
            text = list(base)
            for at in draw.sample(range(120), draw.choice([0, 1, 2, 3, 4])):
                text[at] = draw.choice(vocabulary)
            ending = draw.choices(vocabulary, k=draw.choice([0, 0, 20, 29, 32]))
            rows.append((draw.choice([100 * f + k, 100 * f + k, 7, None]), " ".join(text + ending)))
    for k in range(20):
        item = draw.choice(items[:12])[1]
        rows.append((2000 + k, " ".join(draw.choices(vocabulary, k=draw.choice([10, 400])) + [item.upper()] + draw.choices(vocabulary, k=5))))
    rows += rows[10:14] + [(3000, " ".join(draw.choices(vocabulary, k=30_000)))]
    return [(i, t, draw.choice(["en", "de", None]), draw.choice(["a", "hot", "hot", None]), len(t or "")) for i, t in rows], items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, items = documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/none/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/none/labels.parquet")
    return path


def test_near_duplicates_equal_brute_force(spark, folder):
    rows, _ = documents()
    numbered = list(enumerate(rows))
    component = components_of([(n, r[1]) for n, r in numbered], P.SHINGLE_WORDS, P.SIMILAR_PERCENT)
    groups = {}
    for n, r in numbered:
        groups.setdefault(component[n][1], []).append(r)
    stays = [min(group, key=lambda r: (r[0] is None, r[0] or 0)) for group in groups.values()]
    out = STAGES["near_dedup"](spark, spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    assert sorted((r[0] for r in stays), key=str) == sorted((r.doc_id for r in out.collect()), key=str)
    # Which of the equal ids of a component stays is open; every row is one of the input, and each component has one.
    left = [tuple(r) for r in out.collect()]
    assert len(left) == len(groups) < len(rows) and set(left) <= set(rows)
    assert {r[1] for r in left} >= {t[1] for g in groups.values() if len(g) == 1 for t in g}


def test_decontamination_equals_brute_force(spark, folder):
    rows, items = documents()
    rows = [r for r in rows if r[0] != 3000]
    want = sorted((r for r in rows if not contamination_of([(0, r[1])], items)[0][5]), key=str)
    assert rows_of(STAGES["decontamination"](spark, spark.createDataFrame(rows, SCHEMA), folder)) == want
    assert 0 < len(rows) - len(want) < 25


def test_mixing_and_sharding_equal_brute_force(spark, folder):
    rows = [r for r in documents()[0] if r[0] is not None and r[2] and r[3]]
    rows = list({r[0]: r for r in rows}.values())
    documents_ = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    con = duckdb.connect()
    con.register("documents", documents_)
    taken = {r[0] for r in con.sql(f"SELECT doc_id FROM ({OP4_SQL}) WHERE selected").fetchall()}
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(STAGES["mixing"](spark, df, folder)) == sorted((r for r in rows if r[0] in taken), key=str)
    want = shards_of(documents_, 16, 17)
    got = STAGES["sharding"](spark, df, folder).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted(zip(want.doc_id, want.shard, want.slot, strict=True))


def test_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    want = sorted(r.doc_id for r in quality_model.classify(docs, labels).where("predicted = 1").collect())
    assert sorted(r.doc_id for r in STAGES["quality_model"](spark, docs, FOLDER).collect()) == want
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.exceptAll(docs).count() == 0 and out.count() < docs.count(), name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    last = STAGES["sharding"](spark, docs, FOLDER)
    places = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in df.collect())
    assert last.count() == docs.count() > 50 and places(P.run(spark, FOLDER)) == places(last)


def test_clashing_columns_and_empty_tables(spark, folder):
    more = SCHEMA + ", row_key string, ROW_KEY_ int, gone string, component_id string, contaminated string, score string"
    rows = [(*r, f"k{n}", n, "g", "c", "x", "s") for n, r in enumerate(documents()[0][:40])]
    df = spark.createDataFrame(rows, more)
    for name in ("near_dedup", "decontamination", "mixing"):
        out = STAGES[name](spark, df, folder)
        assert out.columns == df.columns and set(map(tuple, out.collect())) <= set(rows), name
    # Without a benchmark item nothing is contaminated; without rows nothing is left, of any stage.
    assert rows_of(STAGES["decontamination"](spark, df, f"{folder}/none")) == sorted(rows, key=str)
    for name, stage in P.STAGES:
        out = stage(spark, df.where("false"), f"{folder}/none")
        assert out.count() == 0 and (name == "sharding" or out.columns == df.columns), name


def test_each_row_follows_its_own_verdict(spark):
    passage = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 200").orderBy("item_id").first().text
    copied, own = "some words that are long enough to be copied in whole", "quite another text that nobody else has written down before"
    rows = [(3, copied, "en", "s", 1), (7, own, "en", "s", 1), (7, copied, "en", "s", 1), (1, "the least id has words of its own", "en", "s", 1), (None, copied, "en", "s", 1), (7, None, "en", "s", 1)]
    left = rows_of(P.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), FOLDER).select("doc_id", "text"))
    assert left == sorted([(1, rows[3][1]), (3, copied), (7, own), (7, None)], key=str)
    rows = [(None, passage, "en", "s", 1), (None, own, "en", "s", 1), (5, passage, "en", "s", 1), (5, own, "en", "s", 1), (6, None, "en", "s", 1)]
    left = rows_of(P.decontaminate(spark, spark.createDataFrame(rows, SCHEMA), FOLDER).select("doc_id", "text"))
    assert left == sorted([(None, own), (5, own), (6, None)], key=str)


def test_names_and_order():
    assert [name for name, _ in P.STAGES] == ["quality_model", "near_dedup", "decontamination", "mixing", "sharding"]


def test_stored_tables_leave_no_marker(spark):
    """The driver starts child processes for a marker file on a local file system; while one starts, the driver's memory counts twice."""
    store = Store(spark, "no-marker")
    assert store.put(spark.range(5), "five").count() == 5
    names = {p.name for p in Path(store.base.removeprefix("file://"), "five").iterdir()}
    assert "_SUCCESS" not in names and any(n.endswith(".parquet") for n in names)
    store.clear()
