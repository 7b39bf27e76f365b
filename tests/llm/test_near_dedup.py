import random
import re

from riskmart.llm import near_dedup as N
from riskmart.llm.common import Store
from riskmart.llm.components import components

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, width=3):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if x]
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width=3, percent=85):
    sets, parent = {i: shingles(t, width) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def fixture():
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, "É x y z"), (8, "é x y z")]
    for family in range(12):
        base = draw.choices(vocabulary, k=draw.choice([8, 30, 80, 200]))
        rows += [(100 * (family + 1) + k, " ".join(base)) for k in (50, 51)]
        for k in range(25):
            text = list(base)
            for _ in range(draw.randrange(1 + len(base) // 12)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append((100 * (family + 1) + k, draw.choice([" ", "\n", "\t "]).join(text).upper() if k % 5 == 0 else " ".join(text)))
    chain = [f"c{i}" for i in range(160)]
    rows += [(3000 - k, " ".join(chain[4 * k : 4 * k + 80])) for k in range(20)]  # each overlaps the next enough, the ends do not
    return rows


def test_equals_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df, 3, 85).collect()}
    want = brute(rows)
    assert set(got) == set(want) and all(got[i][0] == want[i][0] for i in want)
    assert [i for i in want if got[i] != want[i]] == []


def test_pairs_within_families_just_below_the_similarity(spark, monkeypatch):
    """Members of a family meet in most buckets but are linked with none; the pairs among them are found whatever the centres are."""
    monkeypatch.setattr(N, "CENTRES", 1)
    draw, rows = random.Random(12), []
    for family in range(3):
        places = draw.sample(range(2, 1490, 3), 490)
        copies = []
        for k, own in enumerate([24] * 18 + [19] * 2):  # words of their own, no two at one place: only the last two reach 0.85 together
            text = [f"f{family}w{i}" for i in range(1500)]
            for at in (places.pop() for _ in range(own)):
                text[at] = f"f{family}m{k}x{at}"
            copies.append(text)
        rows += [(1000 * family + k, " ".join(text)) for k, text in enumerate(copies)]
    want = brute(rows)
    assert sum(not kept for _, _, kept in want.values()) == 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df, 3, 85).collect()} == want


def family(size, seed=1, words=400, edits=20, pool=40):
    """Texts over one core with words changed at random places to words of a small pool: they share changes, but no two are similar enough."""
    draw = random.Random(seed)
    core = [f"c{i}" for i in range(words)]
    out = []
    for _ in range(size):
        text = list(core)
        for at in draw.sample(range(words), edits):
            text[at] = f"p{draw.randrange(pool)}"
        out.append(text)
    return out


def test_rest_compares_few_pairs_and_loses_no_link(spark, monkeypatch):
    """Families whose members share changed words: every bucket stays mixed, and what is compared follows the members."""
    compared, exact = [], N.confirmed

    def watched(pairs, *rest):
        compared.append(pairs.count())
        return exact(pairs, *rest)

    monkeypatch.setattr(N, "confirmed", watched)
    for size in (150, 300):
        texts = family(size)
        for k in range(5):  # five pairs above the similarity among them
            texts.append([f"q{k}" if i == 7 * k + 3 else w for i, w in enumerate(texts[11 * k])])
        rows = [(i + 1, " ".join(t)) for i, t in enumerate(texts)]
        want = brute(rows)
        assert sum(not kept for _, _, kept in want.values()) == 5
        got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
        assert compared[-1] <= 2 * size


def test_chains_around_a_core(spark):
    """Members near the core and members further off that share changes with them, other widths and similarities too."""
    draw = random.Random(4)
    rows = []
    for f in range(4):
        core = [f"f{f}c{i}" for i in range(300)]
        groups = [[(draw.randrange(300), f"g{g}x{k}") for k in range(14)] for g in range(6)]
        for k in range(40):
            text = list(core)
            for at, word in draw.choice(groups)[: draw.randrange(15)] + [(draw.randrange(300), f"o{k}y{j}") for j in range(draw.randrange(6))]:
                text[at] = word
            rows.append((1000 * f + k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((3, 85), (5, 80)):
        got = N.near_duplicates(df, width, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, width, percent), (width, percent)


def test_bands_and_sketches():
    assert (N.band_rows(85), N.band_rows(80)) == (6, 5)
    draw = random.Random(2)
    import numpy as np

    for _ in range(20):
        a, b = (np.array(draw.sample(range(1, 2**60), draw.randrange(1, 3000)), np.uint64) for _ in range(2))
        b = np.unique(np.concatenate([b, a[: draw.randrange(len(a))]]))
        bits = sum(bin(int(x) & (2**64 - 1)).count("1") for x in N.sketch(np.unique(a)) ^ N.sketch(b))
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


def test_hot_copies_nulls_and_repeats(spark):
    rows = [(i, "same text for every row of this group") for i in range(500, 900)] + [(i, None) for i in range(950, 960)] + [(None, "same text for every row of this group"), (700, "same text for every row of this group")]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.n_shingles and r.doc_id} == {500} and [r.doc_id for r in got if r.kept and r.n_shingles] == [500]
    assert all(r.component_id == r.doc_id and r.kept for r in got if not r.n_shingles)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, False)]
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(1, 60)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(pairs, "a long, b long"), Store(spark, "test"), "c").collect()
    assert {(r.a, r.b) for r in got} == {(x, find(x)) for x in parent if find(x) != x}


def test_signatures_estimate_similarity():
    draw = random.Random(6)
    words = [f"v{i}" for i in range(300)]
    import pyarrow as pa

    texts = [" ".join(words), " ".join(words[:280] + [f"n{draw.random()}" for _ in range(20)])]
    sets = N.shingle_sets(pa.array(texts), 3)
    exact = len(set(sets[0]) & set(sets[1])) / len(set(sets[0]) | set(sets[1]))
    sig = N.signatures(sets, N._donors())
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.15
