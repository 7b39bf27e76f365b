import numpy as np
import pyarrow as pa
import pytest

from riskmart.llm import language_id as L

FOLDER = "/root/testdata/sf0.01"


def test_windows_cover_each_byte_once():
    lengths = np.array([0, 1, 63, 64, 65, 200])
    owner, start, seen = L.window_starts(lengths)
    for text, n in enumerate(lengths):
        covered = np.zeros(n + L.WINDOW, int)
        for s, k in zip(start[owner == text], seen[owner == text], strict=True):
            covered[s + k : s + L.WINDOW] += 1
        assert (covered[:n] == 1).all()


def test_gradients_equal_differences():
    net = L.ByteGru(["a", "b"], 1)
    draw = np.random.default_rng(0)
    windows, label = draw.integers(0, 256, (6, 5)).astype(np.uint8), np.array([0, 1, 1, 0, 1])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}

    def loss():
        half = [np.zeros((L.HIDDEN, 5))]
        x = net.w["emb"].take(windows, axis=1)
        forward, h = [], half[0]
        for t in range(6):
            h, _ = net._step("f", h, x[:, t])
            forward.append(h)
        total, h = 0.0, half[0]
        for t in range(5, -1, -1):
            h, _ = net._step("b", h, x[:, t])
            z = net.w["fo"] @ forward[t] + net.w["bo"] @ h + net.w["out_b"]
            total += (np.log(np.exp(z).sum(axis=0)) - z[label, np.arange(5)]).sum()
        return total / 30

    g = net.gradients(windows, label)
    for name, value in net.w.items():
        at = tuple(draw.integers(0, s) for s in value.shape) if name != "emb" else (2, int(windows[3, 1]))
        old = value[at]
        value[at] = old + 1e-5
        up = loss()
        value[at] = old - 1e-5
        down = loss()
        value[at] = old
        assert g[name][at] == pytest.approx((up - down) / 2e-5, rel=2e-3, abs=2e-6), name


def test_batches_do_not_change_results():
    net = L.ByteGru(["a", "b", "c"], 2)
    texts = pa.array(["", None, "x", "é" * 500, "word " * 100, "y" * 64])
    whole = L.pooled(net, texts)
    single = np.concatenate([L.pooled(net, texts[i : i + 1]) for i in range(len(texts))])
    assert np.allclose(whole, single, atol=1e-6) and (whole[:2] == 0).all() and np.allclose(whole[2:].sum(axis=1), 1, atol=1e-4)


def test_edges(spark):
    rows = [(i, "the quick brown fox jumps " * 4 if i % 2 else "der schnelle braune fuchs springt " * 4, "en" if i % 2 else "de", 1) for i in range(60)]
    rows += [(100, None, None, 1), (101, "", "en", 1), (102, "12 34!", None, 1), (103, "the fox " * 20_000, None, 1), (104, "ß", "de", 1), (104, "ß", "de", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in L.identify(df).collect()}
    assert len(got) == 65 and L.identify(df).count() == 66
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and [got[i].score for i in (100, 101, 102)] == [0.0] * 3
    assert got[103].lang_pred == "en" and 0 <= got[103].score <= 1
    assert L.identify(df.where("false")).count() == 0
    unlabelled = L.identify(df.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    both = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(both) > 200 and (both.lang == both.lang_pred).mean() > 0.95
