import numpy as np
import pyarrow as pa

from riskmart.llm import quality_model as M

FOLDER = "/root/testdata/sf0.01"


def test_context_does_not_depend_on_batches():
    texts = ["one two three two one", "", None, "UPPER case !!! 12 12 é", "alone", "x y " * 50]
    batch = lambda ts: pa.RecordBatch.from_arrays([pa.array(ts, pa.string())], names=["text"])

    def total(parts):
        out = {}
        for part in parts:
            for row in next(M.context_batches(iter(part))).to_pylist():
                old = out.get(row["place"], [0] * (M.DIMENSIONS + 1))
                out[row["place"]] = [a + b for a, b in zip(old, list(row.values())[1:], strict=True)]
        return out

    assert total([[batch(texts)]]) == total([[batch([t])] for t in texts]) == total([[batch(texts[:2]), batch(texts[2:])]])


def test_context_equals_brute_force():
    text = "the cat saw the dog"
    index = M.index_vectors()
    word, shape, counts = M.places(pa.array([text]))
    near = index[:, word] + index[:, shape]
    want = {}
    for i in range(5):
        around = sum(near[:, j] for j in range(max(0, i - 2), min(5, i + 3)) if j != i)
        for place in (word[i], shape[i]):
            want[int(place)] = want.get(int(place), 0) + around
    got = next(M.context_batches(iter([pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])]))).to_pylist()
    assert {r["place"]: list(r.values())[2:] for r in got} == {k: [int(round(x)) for x in v] for k, v in want.items()}


def test_network_learns_and_is_calibrated():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((3000, 2 * M.DIMENSIONS + 1)).astype(np.float32)
    chance = 1 / (1 + np.exp(-3 * (x[:, 0] + x[:, 1] * x[:, 2])))
    y = (draw.random(3000) < chance).astype(float)
    net = M.fit(x, y)
    p = net.scores(x)
    assert ((p >= 0.5) == (chance >= 0.5)).mean() > 0.8 and 0.25 <= net.temperature <= 8
    assert M.fit(x[:20], np.ones(20)).scores(x[:5]).min() > 0.9
    assert np.allclose(M.fit(x[:0], y[:0]).scores(x[:5]), 0.5)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "plain words here"), (3, "plain words here"), (None, "x"), (4, "w " * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (3, None, 0), (3, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = M.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert M.classify(docs.where("false"), labels).count() == 0
    assert {r.score for r in M.classify(docs, labels.where("false")).collect()} == {0.5}
    extra = docs.selectExpr("text as held_out", "doc_id", "text", "1 as score")
    assert M.accepted(extra, labels).columns == extra.columns and M.accepted(extra, labels).count() == 6


def test_held_out_accuracy_and_acceptance(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scored = M.classify(docs, labels)
    held = scored.join(labels, "doc_id").where("held_out").toPandas()
    assert len(held) > 80 and (held.predicted == held.quality).mean() > 0.95
    kept = {r.doc_id for r in M.accepted(docs, labels).select("doc_id").collect()}
    assert kept == {r.doc_id for r in scored.where("predicted = 1").collect()}
