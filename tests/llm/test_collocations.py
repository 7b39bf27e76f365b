import random
import re
from collections import Counter

import numpy as np

from riskmart.llm import collocations as C

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, top):
    words, grams = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = grams.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] = words.get(lang, 0) + len(w)
            for size in (1, 2, 3):
                f.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in grams.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 10}
        longest = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longest[q] = max(longest[q], a)
        for p, a in candidates.items():
            if len(p) == 2 and 100 * longest[p] >= 50 * a and longest[p]:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, at + 1, x[2].decode(), -x[1], x[3], x[4], words[lang], -x[0]) for at, x in enumerate(sorted(found)[:top])]
    return sorted(out)


def fixture():
    draw = random.Random(12)
    rows = [("en", None), ("en", ""), (None, "a b c\nd"), ("xx", ".,;")]
    for lang in ("en", "de", None, "und", "ß"):
        for _ in range(60):
            vocabulary = ["New", "new", "York", "city", "É", "é", "of", "the", "x\x0by", "don't", "-", "😀"] + [f"w{k}" for k in range(12)]
            text = "".join(draw.choice(vocabulary) + draw.choice([" "] * 8 + ["\t", "  ", ". ", "\n", "!", " ? ", ":"]) for _ in range(draw.randrange(1, 90)))
            rows.append((lang, text + draw.choice(["New York city", "of the of the of the", ""])))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = fixture()
    df = spark.createDataFrame([(i, lang, text, "x") for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, phrase string").repartition(7)
    for top in (2000, 5):
        got = sorted(tuple(r) for r in C.collocations(df, top=top).collect())
        assert got == brute(rows, top) and len(got) > 9
    monkeypatch.setattr(C, "SHARD_BYTES", 64)  # many shards, merged in several rounds; a bit table full of false hits
    monkeypatch.setattr(C, "MERGED", 2)
    monkeypatch.setattr(C, "FILTER_BITS", 64)
    assert sorted(tuple(r) for r in C.collocations(df).collect()) == brute(rows, 2000)


def test_hot_phrase_long_text_and_empty_table(spark):
    rows = [("en", "alpha beta gamma " * 40_000)] + [("en", "alpha beta gamma.")] * 300
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert sorted(tuple(r) for r in C.collocations(df).collect()) == brute(rows, 2000)
    assert C.collocations(df.where("false")).count() == 0


def test_filters_lose_nothing():
    draw = np.random.default_rng(3)
    for size in (2, 3):
        for n in (1, 2, 50, 5000):
            grams = [draw.integers(0, 2**63, n, dtype=np.uint64) for _ in range(size)]
            keys = C.permuted(grams)
            assert all((a == b).all() for a, b in zip(C.unpermuted(keys), grams, strict=True))
            for bits in (0, 3):
                keys, counts = C.counted([np.concatenate([k, k[: n // 2]]) for k in C.permuted(grams)], draw.choice([1, 254, 255, 256, 10**12], n + n // 2))
                shard = int(keys[0][0] >> np.uint64(64 - bits)) if bits else 0
                mine = keys[0] >> np.uint64(64 - bits) == shard if bits else np.ones(len(counts), bool)
                own = [k[mine] for k in keys]
                back, numbers = C.filter_entries(C.filter_bytes(own, counts[mine], bits), shard)
                assert all((a == b).all() for a, b in zip(back, own, strict=True)) and (numbers == counts[mine]).all()


def test_equal_mixed_bits_are_told_apart():
    keys = [np.array([5, 5, 5, 1], np.uint64), np.array([9, 2, 9, 7], np.uint64)]
    got, counts = C.counted(keys)
    assert [g.tolist() for g in got] == [[1, 5, 5], [7, 2, 9]] and counts.tolist() == [1, 1, 2]


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 10**14 + 1, 10**14 + 7, 10**14 + 3
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(C.score_of(df.a, df.l, df.r).alias("s")).first().s == 1_000_000 * a * a // (l * r)
