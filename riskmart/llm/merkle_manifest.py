"""Merkle manifest of a dataset in van Emde Boas layout.

Every row is a leaf. Per source, leaves ascend by id; every 16 consecutive nodes become their hash until one is left, the source's root; the sources' roots
likewise give the root. A tree is stored in blocks: aligned subtrees of ``HEIGHT`` levels over their leaves, each one row with its digests in van Emde Boas
order (the levels are split at half height, the top half first, then each bottom subtree, again and again). An address is computed, never
looked up, and a block ends at its last used address. The roots of the blocks are the leaves of the next tier of blocks, and so on. The path from a
block's root up is found once for each block, tier by tier from the top; the blocks of leaves then serve all siblings of their rows.

No task holds more than a slice of the sorted leaves (digests, no texts) or one block. A hot source is many slices and blocks.

Defined cases: each null field is ``-``. Rows that share an id are leaves of their own, ordered by leaf digest (equal rows are interchangeable); rows
without an id come first and are never tampered with. Rows without a source are one source, before all others. A root over one leaf is the leaf. An
empty table gives an empty result. Only the five columns of a document are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import Store, batches_of, crc_mod, record
from riskmart.sources.tables import broadcast_if_small

FAN = 16
#: Levels of a block above its leaves: 4,096 leaves, 140 KB of digests at most.
HEIGHT = 3
SLICE_ROWS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TEMPER_EVERY = 5


def leaf_digest(fields: list[Column]) -> Column:
    """sha256 (32 bytes) of the fields: ``-`` if null, else the number of UTF-8 bytes, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(df: DataFrame) -> DataFrame:
    """doc_id, tree (the source as a key that is never null and keeps the order), leaf, and tampered: the leaf of the row with its text in lower case (null where the row is not tampered with)."""
    tampered = leaf_digest([F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS])
    return df.select("doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("tree"), leaf_digest([F.col(f) for f in FIELDS]).alias("leaf"), F.when(crc_mod("doc_id", TEMPER_EVERY) == 0, tampered).alias("tampered"))


def tree_size(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Van Emde Boas addresses of nodes of one depth (the root's is 0) in a tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    below = FAN ** (depth - top)
    return tree_size(top) + index // below * tree_size(levels - top) + address(depth - top, index % below, levels - top)


@cache
def addresses(height: int) -> list[list[int]]:
    """Addresses by level from the leaves (0) up to the root of a block."""
    return [address(height - level, np.arange(FAN ** (height - level)), height + 1).tolist() for level in range(height + 1)]


def height_of(n: int) -> int:
    """Levels above n nodes: runs of 16 are taken while there is more than one node."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


def block_nodes(digests: list[bytes], height: int) -> tuple[bytes, bytes]:
    """A block's digests in van Emde Boas order up to the last used address, and its root. ``height`` may exceed what the digests need: single nodes are
    then hashed up, as they are in a tree that goes on beside them."""
    where, level, used = addresses(height), [d.hex() for d in digests], {}
    for k in range(height + 1):
        used.update(zip(where[k], level, strict=False))
        if k < height:
            level = [sha256("".join(level[at : at + FAN]).encode()).hexdigest() for at in range(0, len(level), FAN)]
    nodes = bytearray(32 * (max(used) + 1))
    for at, digest in used.items():
        nodes[32 * at : 32 * at + 32] = bytes.fromhex(digest)
    return bytes(nodes), bytes.fromhex(level[0])


def siblings(nodes: str, n: int, height: int, at: int) -> list[tuple[int, str]]:
    """From the leaf up, the place in its run and the hex digests of the others of the run. ``nodes``: the block's digests as hex text."""
    out, where = [], addresses(height)
    for level in range(height):
        place, first = at % FAN, at - at % FAN
        run = where[level][first : min(first + FAN, n)]
        out.append((place, "".join(nodes[64 * a : 64 * a + 64] for a in run[:place]) + "".join(nodes[64 * a : 64 * a + 64] for a in run[place + 1 :])))
        at, n = at // FAN, -(-n // FAN)
    return out


def folded(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for place, others in path:
        leaf = sha256((others[: 64 * place] + leaf + others[64 * place :]).encode()).hexdigest()
    return leaf


BLOCKS = pa.schema([
    ("tree", pa.string()), ("tier", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("height", pa.int32()), ("nodes", pa.binary()), ("root", pa.binary()),
    ("ids", pa.list_(pa.int64())), ("tampered", pa.list_(pa.binary())),
])
BLOCKS_DDL = "tree string, tier int, block long, n int, height int, nodes binary, root binary, ids array<long>, tampered array<binary>"


def block_of(tier: int, most: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        n, total = group.num_rows, group.column("total")[0].as_py()
        height = min(most, height_of(total))
        nodes, root = block_nodes(group.column("digest").to_pylist(), height)
        row = [[group.column("tree")[0].as_py()], [tier], [group.column("pos")[0].as_py() // FAN**most], [n], [height], [nodes], [root]]
        named = "doc_id" in group.column_names
        row += [[group.column(c).to_pylist() if named else None] for c in ("doc_id", "tampered")]
        return pa.Table.from_batches([record(BLOCKS, row)])

    return run


def placed(rows: DataFrame, order: list[str], store: Store, name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds pos and total within each tree: a range sort in slices, then the first row and the count of each (tree, slice). A slice numbers its rows as
    it is written, so a hot tree is sorted by many tasks."""
    slices = max(1, -(-rows.count() // slice_rows))
    ordered = rows.repartitionByRange(slices, "tree", *order).sortWithinPartitions("tree", *order).withColumn("_at", F.monotonically_increasing_id())
    written = store.put(ordered.withColumn("_slice", F.shiftright("_at", 33)), name)
    cuts = written.groupBy("tree", "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    by_tree = Window.partitionBy("tree")
    before = by_tree.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = cuts.select("tree", "_slice", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_move"), F.sum("_n").over(by_tree).alias("total"))
    starts = store.put(starts, f"{name}-starts")
    return written.join(broadcast_if_small(starts), ["tree", "_slice"]).select(*rows.columns, (F.col("_at") + F.col("_move")).alias("pos"), "total")


def tiers(nodes: DataFrame, store: Store, name: str, most: int) -> list[DataFrame]:
    """Stored blocks of all trees from the leaves up. ``nodes``: tree, pos (from 0 without gaps), total (nodes of the tree), digest."""
    found = []
    while True:
        grouped = nodes.withColumn("block", F.expr(f"pos div {FAN**most}")).groupBy("tree", "block")
        found.append(store.put(grouped.applyInArrow(block_of(len(found), most), BLOCKS_DDL), f"{name}-{len(found)}"))
        high = found[-1].groupBy("tree").agg((F.max("block") + 1).alias("total")).where("total > 1")
        nodes = found[-1].join(broadcast_if_small(high), "tree").select("tree", F.col("block").alias("pos"), "total", F.col("root").alias("digest"))
        if nodes.isEmpty():
            return found


PATH = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))
PATH_DDL = "array<struct<place:int,others:string>>"
MEMBERS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("path", PATH)])


def member_batches(most: int):
    """The path of every lowest node of blocks: its siblings inside, then the path of the block's root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, n = row["nodes"].hex(), row["n"]
                for start in range(0, n, FAN * FAN):
                    at = range(start, min(start + FAN * FAN, n))
                    path = [[{"place": p, "others": o} for p, o in siblings(nodes, n, row["height"], k)] + row["path"] for k in at]
                    yield record(MEMBERS, [[row["tree"]] * len(at), [row["block"] * FAN**most + k for k in at], path])

    return run


def member_paths(blocks: DataFrame, most: int) -> DataFrame:
    """tree, pos, path of the lowest nodes of ``blocks`` (with the path of their roots)."""
    return batches_of(blocks.sparkSession, blocks.select("tree", "block", "n", "height", "nodes", "path"), member_batches(most), f"tree string, pos long, path {PATH_DDL}")


def with_paths(found: list[DataFrame], store: Store, name: str, most: int, ends: DataFrame | None = None) -> DataFrame:
    """The lowest blocks with the path of their roots: up to the root of their tree, then on by the tree's own path in ``ends`` (tree, path)."""
    above, none = None, F.array().cast(PATH_DDL)
    for tier in range(len(found) - 1, -1, -1):
        blocks = found[tier].withColumn("path", F.lit(None).cast(PATH_DDL))
        if above is not None:
            upper = above.withColumnsRenamed({"pos": "block", "path": "_up"})
            blocks = blocks.join(broadcast_if_small(upper), ["tree", "block"], "left").withColumn("path", F.col("_up")).drop("_up")
        if ends is not None:  # a block that is its tree's only one in its tier
            blocks = blocks.join(broadcast_if_small(ends.withColumnRenamed("path", "_end")), "tree", "left").withColumn("path", F.coalesce("path", "_end")).drop("_end")
        blocks = blocks.withColumn("path", F.coalesce("path", none))
        if tier:
            above = store.put(member_paths(blocks, most), f"{name}-up-{tier}")
    return blocks


PROOF = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()),
])
PROOF_DDL = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, n, height = row["nodes"].hex(), row["n"], row["height"]
                up = [(step["place"], step["others"]) for step in row["path"]]
                above, where, out = "".join(o for _, o in up), addresses(height)[0], []
                for at in range(n):
                    leaf = nodes[64 * where[at] : 64 * where[at] + 64]
                    own = siblings(nodes, n, height, at)
                    proof = sha256(("".join(o for _, o in own) + above).encode()).hexdigest()
                    other = row["tampered"][at]
                    got = folded(leaf if other is None else other.hex(), own + up)
                    out.append((row["ids"][at], leaf, row["subroot"].hex(), root, proof, got, got == root))
                yield record(PROOF, zip(*out, strict=True))

    return run


def manifest(df: DataFrame, store: Store, most: int = HEIGHT, slice_rows: int = SLICE_ROWS) -> tuple[list[DataFrame], DataFrame, list[DataFrame]]:
    """Stored: tiers of blocks of the sources' trees; the sources' roots in order (tree, name, digest, pos, total); tiers of blocks of the tree over them."""
    sources = tiers(placed(leaves(df).withColumnRenamed("leaf", "digest"), ["doc_id", "digest"], store, "leaves", slice_rows), store, "sources", most)
    every = sources[0].select("tree", "tier", "root")
    for tier in sources[1:]:
        every = every.unionByName(tier.select("tree", "tier", "root"))
    roots = every.groupBy(F.col("tree").alias("name")).agg(F.max_by("root", "tier").alias("digest")).select(F.lit("top").alias("tree"), "name", "digest")
    subroots = store.put(placed(roots, ["name"], store, "roots", slice_rows), "subroots")
    return sources, subroots, tiers(subroots.drop("name"), store, "top", most)


def proofs(df: DataFrame, store: Store | None = None, most: int = HEIGHT, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    Blocks have ``most`` levels above their leaves at most. A caller that gives its own ``store`` may clear it once the result is written.
    """
    store = store or Store(df.sparkSession, "merkle")
    sources, subroots, top = manifest(df, store, most, slice_rows)
    last = top[-1].first()
    if last is None:
        return df.sparkSession.createDataFrame([], PROOF_DDL)
    members = member_paths(with_paths(top, store, "top", most), most)
    ends = store.put(subroots.join(members, ["tree", "pos"]).select(F.col("name").alias("tree"), "digest", "path"), "ends")
    blocks = with_paths(sources, store, "source", most, ends.select("tree", "path"))
    blocks = blocks.join(broadcast_if_small(ends.select("tree", F.col("digest").alias("subroot"))), "tree")
    return batches_of(df.sparkSession, blocks.select("n", "height", "nodes", "ids", "tampered", "path", "subroot"), prove(last.root.hex()), PROOF_DDL)
