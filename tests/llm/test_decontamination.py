import hashlib
import random
import re

from riskmart.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, exact, near = words(text), set(), set(), set()
        for item_id, item in items:
            iw = words(item)
            n = min(len(iw), 13)
            for at in range(len(iw) - n + 1 if n else 0):
                for i in range(len(w) - n + 1):
                    differ = sum(a != b for a, b in zip(w[i : i + n], iw[at : at + n], strict=True))
                    if differ == 0:
                        exact.add(("" if item_id is None else str(item_id)))
                        hit.update(range(i, i + n))
                    elif n == 13 and differ <= 2:
                        near.add(("" if item_id is None else str(item_id)))
        names = ",".join(sorted(exact))
        out.append((doc_id, len(w), len(hit), len(exact), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w), len(near - exact)))
    return sorted(out, key=str)


def fixture():
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["the", "Ärger", "ñ", "a9"]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 12, 13, 14, 30])))) for i in range(25)] + [(98, None), (99, "..."), (None, "lonely item"), (3, "same id again")]
    docs = [(7, None), (8, ""), (9, "!!"), (10, "lonely"), (11, "item lonely ITEM")]
    for i in range(60):
        text = draw.choices(vocabulary, k=draw.randrange(40))
        for _, item in draw.sample(items[:25], 2):
            own = item.split()
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                own[draw.randrange(len(own))] = "changed"
            text += [x.upper() if draw.random() < 0.3 else x for x in own] + draw.choices(vocabulary, k=3)
        docs.append((i, draw.choice([" ", ", ", "\n"]).join(text)))
    return docs + docs[-2:], items


def test_equals_brute_force(spark, monkeypatch):
    docs, items = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, near string")
    tests = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, item string")
    want = brute(docs, items)
    assert sum(r[5] for r in want) > 20 and sum(r[6] for r in want) > 10
    assert sorted((tuple(r) for r in D.contamination(df, tests).collect()), key=str) == want
    monkeypatch.setattr(D, "BLOCK_BYTES", 500)  # several blocks of test items give the same rows
    assert sorted((tuple(r) for r in D.contamination(df, tests).collect()), key=str) == want
    monkeypatch.setattr(D, "SEGMENT_BYTES", 200)  # and so do small segments
    exact = [(*r[:6], 0) for r in want]
    assert sorted((tuple(r) for r in D.contamination(df, tests, misses=0).collect()), key=str) == sorted(exact, key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(docs.where("false"), items).count() == 0
    assert {(r.doc_id, r.n_hit, r.contaminated) for r in D.contamination(docs, items.where("false")).collect()} == {(1, 0, False), (None, 0, False)}
    assert {(r.doc_id, r.n_hit, r.contaminated) for r in D.contamination(docs, items).collect()} == {(1, 2, True), (None, 2, True)}
