import random
import zlib
from hashlib import sha256

import numpy as np

from riskmart.llm import merkle_manifest as M

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, at):
    out = []
    for level in tree[:-1]:
        run, place = level[at - at % 16 : at - at % 16 + 16], at % 16
        out.append((run[:place], run[place + 1 :]))
        at //= 16
    return out


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf_of(*r) for r in rows if r[3] == s]) for s in sources}
    top, seen, out = levels([trees[s][-1][0] for s in sources]), dict.fromkeys(sources, 0), []
    for doc_id, text, lang, source, n_chars in rows:
        leaf, tree = leaf_of(doc_id, text, lang, source, n_chars), trees[source]
        steps = path(tree, seen[source]) + path(top, sources.index(source))
        seen[source] += 1
        other = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        node = leaf_of(doc_id, text.translate(LOWER) if text is not None else None, lang, source, n_chars) if other else leaf
        for before, after in steps:
            node = digest(*before, node, *after)
        out.append((doc_id, leaf, tree[-1][0], top[-1][0], digest(*[d for b, a in steps for d in b + a]), node, node == top[-1][0]))
    return sorted(out, key=str)


def fixture():
    draw = random.Random(11)
    sizes = {None: 3, "": 1, "a": 1, "b": 16, "c": 17, "d": 256, "e": 257, "hot": 700, "é": 40} | {f"s{i:02}": draw.randrange(1, 9) for i in range(20)}
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = draw.choice([None, "", "small", "Upper Case É", "ÀB", "12:x"])
            rows.append((draw.randrange(10_000) if draw.random() > 0.02 else None, text, draw.choice([None, "en"]), source, draw.choice([None, 0, 123456789012])))
    return rows + rows[:20] + [(5, None, None, None, None)] * 2


def test_equals_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", root string")
    assert sorted((tuple(r) for r in M.proofs(df).collect()), key=str) == brute(rows)
    # Blocks of two levels and slices of few rows: several tiers of blocks in one source.
    assert sorted((tuple(r) for r in M.proofs(df, most=1, slice_rows=100).collect()), key=str) == brute(rows)


def test_one_row_long_text_and_empty_table(spark):
    rows = [(7, "Long " * 300_000, "en", "s", 1)]
    assert [tuple(r) for r in M.proofs(spark.createDataFrame(rows, SCHEMA)).collect()] == brute(rows)
    empty = M.proofs(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_van_emde_boas_order():
    """Addresses of a block are a permutation, every subtree of half the height stands in one piece, top half first."""
    for height in range(4):
        where = M.addresses(height)
        assert sorted(a for level in where for a in level) == list(range(M.tree_size(height + 1)))
    where = M.addresses(3)
    assert sorted([*where[3], *where[2]]) == list(range(17))
    for k in range(256):
        own = [where[1][k], *where[0][16 * k : 16 * k + 16]]
        assert sorted(own) == list(range(17 + 17 * k, 34 + 17 * k))
    nodes, root = M.block_nodes([bytes([k % 256]) * 32 for k in range(300)], 3)
    assert len(nodes) == 32 * (max(np.array(where[0])[:300].max(), where[1][18]) + 1) and nodes[:32] == root
