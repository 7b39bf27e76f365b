"""Phrase collocations counted in counting quotient filters.

A word's id is a 64-bit hash that is checked to be one to one wherever it counts: were two words of one language to share an id, all is counted again
under another seed. An n-gram is its packed word ids. An invertible permutation mixes all of them into the first 64 bits; of these, the highest bits name the
shard, the next ones are the quotient and the rest, with the other ids, is the remainder. A filter keeps the remainders sorted in runs by quotient,
a bit for each quotient that occurs, a bit for each end of a run, and a counter of one byte that spills over where it must. Nothing is
rounded, so ids and counts come back whole. Each batch of texts gives one filter for each language and shard; sorted filters are merged, many at a
time, until each shard has one.

Phrases are grown as they must occur: bigrams of words with ``least`` occurrences, trigrams of bigrams with as many. Which words and bigrams
these are is told to the tasks by a bit table of at most ``FILTER_BITS`` bits; a false hit costs room only, since every count is exact. Words
are never collected, and no table grows with the vocabulary.

Defined cases: a null text is empty, a null language is ``und``; an empty table, or one without frequent phrases, gives an empty result. Repeated rows
count again. Only text and language are read, so other columns cannot clash. Texts are counted whole, a long one in a batch of its own.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import Store, batches_of, byte_class, lower_ascii, mixed, record, span_hashes, text_bytes, text_pieces, word_spans
from riskmart.sources.tables import broadcast_if_small

LEAST, TOP, INSIDE = 10, 2000, 50
FILTER_BITS = 1 << 28
#: Bytes of n-grams that a shard may hold at most, if all were distinct; filters that are merged at a time.
SHARD_BYTES, MERGED = 1 << 23, 512
#: The first rows of a language are taken in so many slices, then in one.
RANK_SLICES = 64
#: At most 15 digits of a count keep every product below within 38 digits.
_EXACT = "decimal(15,0)"
_BREAKS = byte_class((0x0A, 0x0D), (0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
_WORD = ~(_BREAKS | byte_class((0x09, 0x09), (0x20, 0x20)))
_M1, _M2 = (np.uint64(pow(m, -1, 1 << 64)) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def unmixed(values: np.ndarray) -> np.ndarray:
    """The inverse of ``mixed``."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((31, _M2), (27, _M1), (30, None)):
        k = shift
        while k < 64:
            x ^= x >> np.uint64(k)
            k *= 2
        if factor is not None:
            x *= factor
    return x


def permuted(grams: list[np.ndarray]) -> list[np.ndarray]:
    """n-grams, one array for each place, with the first 64 bits mixed from all places; invertible."""
    rest = np.zeros(len(grams[0]), np.uint64)
    for word in grams[:0:-1]:
        rest = mixed(word + rest)
    return [mixed(grams[0] ^ rest), *grams[1:]]


def unpermuted(keys: list[np.ndarray]) -> list[np.ndarray]:
    rest = np.zeros(len(keys[0]), np.uint64)
    for word in keys[:0:-1]:
        rest = mixed(word + rest)
    return [unmixed(keys[0]) ^ rest, *keys[1:]]


def counted(keys: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order and their counts."""
    counts = np.ones(len(keys[0]), np.int64) if counts is None else counts
    order = np.argsort(keys[0], kind="stable")
    ordered = [k[order] for k in keys]
    same = ordered[0][1:] == ordered[0][:-1]
    if any((k[1:] != k[:-1])[same].any() for k in ordered[1:]):  # equal in the mixed bits alone
        order = np.lexsort(keys[::-1])
        ordered = [k[order] for k in keys]
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = np.any([k[1:] != k[:-1] for k in ordered], axis=0)
    at = np.flatnonzero(first)
    return [k[at] for k in ordered], np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)


def filter_bytes(keys: list[np.ndarray], counts: np.ndarray, shard_bits: int) -> bytes:
    """A counting quotient filter of sorted distinct keys of one shard."""
    n = len(counts)
    q = max(3, min(16, n.bit_length() - 3))
    left = (keys[0] << np.uint64(shard_bits)) if shard_bits else keys[0]
    quotient = (left >> np.uint64(64 - q)).astype(np.int64)
    width = 64 - shard_bits - q
    remainder = keys[0] & np.uint64((1 << width) - 1)
    occupied, ends = np.zeros(1 << q, bool), np.ones(n, bool)
    occupied[quotient] = True
    ends[:-1] = quotient[1:] != quotient[:-1]
    low = np.ascontiguousarray(remainder.astype("<u8")).view(np.uint8).reshape(n, 8)[:, : (width + 7) // 8]
    over = counts[counts >= 255].astype("<i8")
    return b"".join([
        struct.pack("<BBBqq", len(keys), shard_bits, q, n, len(over)), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), low.tobytes(),
        *[k.astype("<u8").tobytes() for k in keys[1:]], np.minimum(counts, 255).astype(np.uint8).tobytes(), over.tobytes(),
    ])


def filter_entries(data: bytes, shard: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys and counts that a filter holds: the inverse of ``filter_bytes``."""
    size, shard_bits, q, n, n_over = struct.unpack_from("<BBBqq", data)
    at = struct.calcsize("<BBBqq")

    def take(length: int) -> np.ndarray:
        nonlocal at
        at += length
        return np.frombuffer(data, np.uint8, length, at - length)

    occupied = np.flatnonzero(np.unpackbits(take((1 << q) // 8)))
    ends = np.unpackbits(take((n + 7) // 8))[:n]
    width = 64 - shard_bits - q
    low = np.zeros((n, 8), np.uint8)
    low[:, : (width + 7) // 8] = take(n * ((width + 7) // 8)).reshape(n, (width + 7) // 8)
    quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64)
    first = low.view("<u8").reshape(n) | quotient << np.uint64(width)
    if shard_bits:
        first |= np.uint64(shard) << np.uint64(64 - shard_bits)
    rest = [take(8 * n).view("<u8").astype(np.uint64) for _ in range(size - 1)]
    counts = take(n).astype(np.int64)
    counts[counts == 255] = take(8 * n_over).view("<i8")
    return [first.astype(np.uint64), *rest], counts


def tokens(texts: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and ids of all words, the text of each, and whether it follows the word before in one piece."""
    data, starts = text_bytes(texts)
    data = lower_ascii(data)
    begins, ends, counts = word_spans(data, starts, _WORD)
    if seed:
        ids = span_hashes(np.random.default_rng(seed).permutation(256).astype(np.uint8)[data], begins, ends)
    else:
        ids = span_hashes(data, begins, ends)
    broken = np.concatenate([[0], np.cumsum(_BREAKS[data], dtype=np.int32)])[begins]
    owner = np.repeat(np.arange(len(counts)), counts)
    follows = np.zeros(len(begins), bool)
    follows[1:] = (broken[1:] == broken[:-1]) & (owner[1:] == owner[:-1])
    return data, begins, ends, ids, owner, follows


def by_language(batch: pa.RecordBatch, owner: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """Each language of a batch, with a flag for each of its words."""
    coded = batch.column("lang").fill_null("und").dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)[owner] if len(owner) else np.zeros(0, np.int64)
    for code, lang in enumerate(coded.dictionary.to_pylist()):
        mine = codes == code
        if mine.any():
            yield lang, mine


def strings(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - begins
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    where = np.repeat(begins - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[where].tobytes())])


WORDS = pa.schema([("lang", pa.string()), ("id", pa.int64()), ("word", pa.string()), ("n", pa.int64())])


def word_batches(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch):
                data, begins, ends, ids, owner, _ = tokens(piece.column("text"), seed)
                for lang, mine in by_language(piece, owner):
                    own = np.flatnonzero(mine)
                    distinct, first, counts = np.unique(ids[own], return_index=True, return_counts=True)
                    at = own[first]
                    yield record(WORDS, [pa.array([lang] * len(at), pa.string()), distinct.view(np.int64), strings(data, begins[at], ends[at]), counts])

    return run


def word_counts(rows: DataFrame, store: Store) -> tuple[DataFrame, int]:
    """Stored lang, id, word, n of every word, and the seed under which no two words that matter share an id."""
    for seed in range(16):
        found = batches_of(rows.sparkSession, rows, word_batches(seed), "lang string, id long, word string, n long")
        words = store.put(found.groupBy("lang", "id", "word").agg(F.sum("n").alias("n")), f"words-{seed}")
        if words.groupBy("lang", "id").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).where(f"words > 1 and n >= {LEAST}").isEmpty():
            return words, seed
    raise RuntimeError("No seed of the word hash tells all words apart.")


def bit_table(hashes: DataFrame) -> np.ndarray:
    """Bits of a column ``h`` of hashes as a table whose size is a power of two, at most ``FILTER_BITS``."""
    bits = min(FILTER_BITS, 1 << max(10, (16 * hashes.count()).bit_length()))
    slots = hashes.select(F.col("h").bitwiseAND(F.lit(bits - 1)).alias("slot"))
    cells = slots.groupBy(F.expr("slot >> 6").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    found = cells.toArrow()  # FILTER_BITS / 64 rows at most
    table = np.zeros(bits >> 6, np.int64)
    table[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def among(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(64 * len(table) - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left ^ mixed(right))


FILTERS = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("part", pa.int64()), ("filter", pa.binary())])
FILTERS_DDL = "lang string, shard int, part long, filter binary"


def gram_batches(size: int, shard_bits: int, seed: int, table):
    """Filters of the n-grams of each batch. ``table`` (broadcast) flags frequent words for bigrams, frequent bigrams for trigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 24
        for batch in batches:
            for piece in text_pieces(batch):
                _, _, _, ids, owner, follows = tokens(piece.column("text"), seed)
                if len(ids) < size:
                    continue
                known = among(table.value, ids) if size == 2 else among(table.value, pair_hash(ids[:-1], ids[1:])) & follows[1:]
                starts = known[:-1] & known[1:]
                if size == 2:
                    starts &= follows[1:]
                for lang, mine in by_language(piece, owner):
                    at = np.flatnonzero(starts & mine[: len(starts)])
                    if not len(at):
                        continue
                    keys, counts = counted(permuted([ids[at + k] for k in range(size)]))
                    cuts = np.searchsorted(keys[0] >> np.uint64(64 - shard_bits), np.arange((1 << shard_bits) + 1)) if shard_bits else np.array([0, len(counts)])
                    filled = np.flatnonzero(np.diff(cuts))
                    made = [filter_bytes([k[cuts[s] : cuts[s + 1]] for k in keys], counts[cuts[s] : cuts[s + 1]], shard_bits) for s in filled]
                    yield record(FILTERS, [[lang] * len(made), filled, [part] * len(made), made])
                part += 1

    return run


def _merged(group: pa.Table) -> tuple[list[np.ndarray], np.ndarray, int]:
    shard = group.column("shard")[0].as_py()
    parts = [filter_entries(data, shard) for data in group.column("filter").to_pylist()]
    keys = [np.concatenate([p[0][k] for p in parts]) for k in range(len(parts[0][0]))]
    return *counted(keys, np.concatenate([p[1] for p in parts])), shard


def merge_filters(group: pa.Table) -> pa.Table:
    keys, counts, shard = _merged(group)
    bits = group.column("filter")[0].as_py()[1]
    return pa.Table.from_batches([record(FILTERS, [[group.column("lang")[0].as_py()], [shard], [group.column("part")[0].as_py()], [filter_bytes(keys, counts, bits)]])])


def frequent_of(size: int):
    schema = pa.schema([("lang", pa.string()), *[(f"x{k}", pa.int64()) for k in range(size)], ("h0", pa.int64()), ("f", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        keys, counts, _ = _merged(group)
        often = counts >= LEAST
        grams = unpermuted([k[often] for k in keys])
        columns = [[group.column("lang")[0].as_py()] * int(often.sum()), *[g.view(np.int64) for g in grams], pair_hash(grams[0], grams[1]).view(np.int64), counts[often]]
        return pa.Table.from_batches([record(schema, columns)])

    return run


def frequent_grams(rows: DataFrame, size: int, shard_bits: int, seed: int, flags: np.ndarray, store: Store) -> DataFrame:
    """Stored lang, x0 to x(size - 1), h0 (hash of the first two), f of the n-grams with ``LEAST`` occurrences or more."""
    spark = rows.sparkSession
    table = spark.sparkContext.broadcast(flags)
    filters = store.put(batches_of(spark, rows, gram_batches(size, shard_bits, seed, table), FILTERS_DDL), f"filters-{size}")
    number = 0
    while True:
        most = filters.groupBy("lang", "shard").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= MERGED:
            break
        number += 1
        salted = filters.withColumn("salt", F.pmod(F.xxhash64("part"), F.lit(-(-most // (MERGED // 2)))))
        filters = store.put(salted.groupBy("lang", "shard", "salt").applyInArrow(lambda group: merge_filters(group), FILTERS_DDL), f"filters-{size}-{number}")
    ddl = "lang string, " + ", ".join(f"x{k} long" for k in range(size)) + ", h0 long, f long"
    found = store.put(filters.groupBy("lang", "shard").applyInArrow(frequent_of(size), ddl), f"grams-{size}")
    store.drop(f"filters-{size}", *[f"filters-{size}-{k + 1}" for k in range(number)])
    table.destroy()
    return found


def score_of(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact decimals."""
    exact = lambda c: c.cast(_EXACT)
    top = (exact(a) * exact(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, exact(left) * exact(right))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, store: Store | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    spark = df.sparkSession
    store = store or Store(spark, "phrases")
    rows = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    words, seed = word_counts(rows, store)
    totals = store.put(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    often = store.put(words.where(F.col("n") >= LEAST), "often")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shard_bits = min(20, (total * 16 // SHARD_BYTES).bit_length())
    two = frequent_grams(rows, 2, shard_bits, seed, bit_table(often.select(F.col("id").alias("h"))), store)
    three = frequent_grams(rows, 3, shard_bits, seed, bit_table(two.select(F.col("h0").alias("h"))), store)

    word = lambda k: often.select("lang", F.col("id").alias(f"x{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"f{k}"))
    with_words = lambda grams, size: [grams := grams.join(broadcast_if_small(word(k)), ["lang", f"x{k}"]) for k in range(size)][-1]
    pair = lambda a, b: two.select("lang", F.col("x0").alias(f"x{a}"), F.col("x1").alias(f"x{b}"), F.col("f").alias(f"f{a}{b}"))
    inside = three.select("lang", "x0", "x1", "f").union(three.select("lang", "x1", "x2", "f")).groupBy("lang", "x0", "x1").agg(F.max("f").alias("longer"))
    alone = two.join(inside, ["lang", "x0", "x1"], "left").where(f"longer is null or 100 * longer < {INSIDE} * f")
    found2 = with_words(alone, 2).select(
        "lang", F.concat_ws(" ", "w0", "w1").alias("phrase"), F.col("f").alias("a"), F.col("f0").alias("l"), F.col("f1").alias("r"), score_of(F.col("f"), F.col("f0"), F.col("f1")).alias("score"),
    )
    cut = lambda left, right: F.struct(score_of(F.col("f"), left, right).alias("score"), left.alias("l"), right.alias("r"))
    parts = with_words(three.join(pair(0, 1), ["lang", "x0", "x1"]).join(pair(1, 2), ["lang", "x1", "x2"]), 3)
    cuts = parts.withColumns({"first": cut(F.col("f0"), F.col("f12")), "second": cut(F.col("f01"), F.col("f2"))})
    least = F.when(F.col("first.score") <= F.col("second.score"), F.col("first")).otherwise(F.col("second"))
    found3 = cuts.select("lang", F.concat_ws(" ", "w0", "w1", "w2").alias("phrase"), F.col("f").alias("a"), least.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = found2.unionByName(found3).withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES)))
    near = sliced.withColumn("at", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("at") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
