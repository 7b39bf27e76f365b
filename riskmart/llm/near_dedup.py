"""Near duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidates.

A document's set is that of its distinct word shingles. One hash of each shingle gives bin and value; an empty bin takes the value of a bin drawn by
a fixed random sequence of its own, the same for all documents. Some bins make a band; documents that agree on a band meet in a bucket.

Documents with one and the same set are a class and represented by its smallest id. In a bucket, candidates are stars: few centres, each with
all others, so their number follows the bucket's size and not its square. Confirmed links (on the full sets) join documents to components. A bucket
whose members are then in more than one component gets other centres, against all members of other components, for ``ROUNDS`` rounds.

What buckets still hold in several components is settled exactly (``_rest``), so that each pair that shares a band is linked, in one component already,
or known to be below the similarity. Buckets that share members make a family. A member is told by its differences from the family's core (the
shingles that most members have): of two members with d and e differences, c of them common, the sets differ in d + e - 2c shingles. So two
members that are near enough to the core are linked whatever their differences are, and a star around the member nearest to the core joins them
all; any other link needs common differences, and two sets that have enough of them share one of the rarest of each (a prefix). Only members
that do meet, on that difference. Sizes, places and a parity sketch of 1,024 bits, which bounds the symmetric difference from below, rule out pairs
before any set moves. No bucket, list or partner is capped.

The number of bands follows the similarity: at it, two documents share none with a probability of 1e-4 at most. That is the only way to lose a link.

Defined cases: a null, empty or blank text has an empty set, is linked with nothing and is its own component. With fewer words than a shingle the whole
sequence is the one shingle. Rows that share an id count as one document. A null id gets a null component and is not kept. An empty table gives an
empty result. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import Store, batches_of, byte_class, lower_ascii, mixed, record, span_hashes, text_bytes, text_pieces, word_spans
from riskmart.llm.components import components
from riskmart.sources.tables import broadcast_if_small

BINS = 128
MISS = 1e-4
PIECE = 1 << 20
SKETCH_WORDS = 16
#: Rounds of stars before the rest is settled.
ROUNDS = 1
#: Centres of a bucket's star in one round: candidates are at most this many times the bucket's members.
CENTRES = 3
#: Ids of documents whose sets are needed are broadcast below this many, else shuffled.
BROADCAST_IDS = 500_000
_WORD = byte_class((0x09, 0x0D), (0x20, 0x20), inverted=True)


def _donors(attempts: int = 4096, seed: int = 23) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, BINS, size=(attempts, BINS))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, starts = text_bytes(texts)
    data = lower_ascii(data)
    begins, ends, counts = word_spans(data, starts, _WORD)
    words = span_hashes(data, begins, ends)
    reach = max(len(words) - width + 1, 0)
    shingles = np.full(reach, width, dtype=np.uint64)
    for k in range(width):
        shingles = mixed(shingles ^ words[k : k + reach])
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(shingles[at : at + n - width + 1]))
        else:
            whole = np.full(1, n, dtype=np.uint64)
            for word in words[at : at + n]:
                whole = mixed(whole ^ word)
            out.append(whole[: min(n, 1)])
        at += n
    return out


def signatures(sets: list[np.ndarray], donors: np.ndarray) -> np.ndarray:
    """(document, bin) minima after densification; rows of empty sets are meaningless."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    cell = np.repeat(np.arange(len(sets)), sizes) * BINS + (values >> np.uint64(57)).astype(np.int64)
    first = np.ones(len(cell), dtype=bool)
    first[1:] = cell[1:] != cell[:-1]  # a set is sorted, so the first value of a bin is its least
    sig, full = np.zeros(len(sets) * BINS, np.uint64), np.zeros(len(sets) * BINS, bool)
    sig[cell[first]], full[cell[first]] = values[first], True
    empty = np.flatnonzero(~full & np.repeat(sizes > 0, BINS))
    for attempt in range(len(donors)):
        if not len(empty):
            break
        source = empty - empty % BINS + donors[attempt][empty % BINS]
        ok = full[source]
        sig[empty[ok]] = sig[source[ok]]
        empty = empty[~ok]
    for at in empty:  # not once in a very long sequence of draws: the next full bin
        own = np.flatnonzero(full[at - at % BINS : at - at % BINS + BINS])
        sig[at] = sig[at - at % BINS + own[0]]
    return sig.reshape(len(sets), BINS)


def band_rows(percent: int) -> int:
    """The most rows a band may have if two documents at the similarity are to share one of the bands with probability 1 - ``MISS``."""
    fits = [r for r in range(1, BINS) if (1 - (percent / 100) ** r) ** (BINS // r) <= MISS]
    return max(fits, default=1)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    bands = BINS // rows
    keys = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(sig), axis=0)
    parts = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    for r in range(rows):
        keys = mixed(keys ^ parts[:, :, r])
    return keys.view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each of 1,024 places: two sketches differ in no more bits than the sets in shingles."""
    odd = np.bincount((shingles & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])


def sign_batches(width: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        donors = _donors()
        for batch in batches:
            for piece in text_pieces(batch, PIECE):
                sets = shingle_sets(piece.column("text"), width)
                keys = band_keys(signatures(sets, donors), rows)
                yield record(SIGNED, [
                    piece.column("doc_id"), [len(s) for s in sets], [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    [k if len(s) else None for k, s in zip(keys, sets, strict=True)],
                ])

    return run


SETS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64())), ("digest", pa.binary()), ("bits", pa.list_(pa.int64()))])
SETS_DDL = "id long, n long, shingles array<long>, digest binary, bits array<long>"


def set_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, PIECE):
                sets = shingle_sets(piece.column("text"), width)
                yield record(SETS, [
                    piece.column("doc_id"), [len(s) for s in sets], [s.view(np.int64) for s in sets],
                    [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], [sketch(s) for s in sets],
                ])

    return run


def _apart(left: str, right: str) -> str:
    """SQL: the bits in which two sketches differ."""
    return f"aggregate(zip_with({left}, {right}, (l, r) -> bit_count(l ^ r)), 0, (total, n) -> total + n)"


def confirmed(pairs: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough. Sizes and sketches decide first; of the pairs they leave, one set moves with each."""
    side = lambda c: broadcast_if_small(sketches.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits_{c}")))
    sized = pairs.join(side("b"), "b").join(side("a"), "a").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    likely = sized.where(f"{100 + percent} * {_apart('bits_a', 'bits_b')} <= {100 - percent} * (na + nb)").select("a", "b").distinct()
    left = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    right = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    both = likely.join(left, "b").join(right, "a").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b").distinct()


def _centres(labelled: DataFrame, number: int) -> DataFrame:
    """(key, centre, centre_label): ``CENTRES`` members of each bucket that has more than one component. The first centre is the smallest id;
    each other one is drawn by component first and then by member, so that members outside a bucket's main component soon stand there. A draw has
    one order for all buckets: documents that meet in many of them then mostly meet the same centres, and a pair is compared once."""
    sums = [F.min("label").alias("least"), F.max("label").alias("most")]
    for k in range(CENTRES):
        salt = F.lit(number * CENTRES + k)
        of_label = F.xxhash64("label", salt).bitwiseAND(F.lit(~0xFFFFF))
        order = F.col("id") if number == k == 0 else of_label.bitwiseOR(F.xxhash64("id", salt).bitwiseAND(F.lit(0xFFFFF)))
        sums += [F.min_by("id", order).alias(f"id_{k}"), F.min_by("label", order).alias(f"label_{k}")]
    drawn = labelled.groupBy("key").agg(*sums).where("least < most")
    return drawn.select("key", F.explode(F.array(*[F.struct(F.col(f"id_{k}").alias("centre"), F.col(f"label_{k}").alias("centre_label")) for k in range(CENTRES)])).alias("c")).select("key", "c.*")


def _mixed(labelled: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    split = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.min("id").alias("low")).where("least < most").select("key", "low")
    return labelled.join(split, "key")


def _differences(rest: DataFrame, sets: DataFrame, percent: int, store: Store) -> DataFrame:
    """Stored: for each set of a mixed bucket its family, label, differences from the family's core (rarest in the family first), their number, and the
    excess: two sets with c common differences are linked if their excesses add up to 2 * (100 + percent) * c at most."""
    tied = components(rest.select(F.col("id").alias("a"), F.col("low").alias("b")).distinct(), store, "families")
    label = rest.select("id", "label").distinct()
    of = label.join(tied.withColumnsRenamed({"a": "id", "b": "family"}), "id", "left").withColumn("family", F.coalesce("family", "id"))
    held = store.put(sets.join(broadcast_if_small(store.put(of, "family-of")), "id"), "held")
    sizes = held.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    holders = held.select("family", F.explode("shingles").alias("s")).groupBy("family", "s").agg(F.count(F.lit(1)).alias("holders"))
    core = holders.join(broadcast_if_small(store.put(sizes, "family-sizes")), "family").where("2 * holders > members")
    # A core has less than twice the shingles of the mean set of its family.
    cores = store.put(core.groupBy("family").agg(F.collect_list("s").alias("core")), "cores")
    apart = held.join(broadcast_if_small(cores), "family", "left").withColumn("core", F.coalesce("core", F.array().cast("array<long>")))
    differing = store.put(apart.withColumn("d", F.concat(F.array_except("shingles", "core"), F.array_except("core", "shingles"))).drop("shingles", "core"), "differing")
    one = differing.select("family", "id", "digest", F.explode("d").alias("s"))
    rarity = one.groupBy("family", "s").agg(F.count(F.lit(1)).alias("holders"))
    ordered = one.join(rarity, ["family", "s"]).groupBy("family", "id", "digest").agg(F.sort_array(F.collect_list(F.struct("holders", "s"))).alias("ordered"))
    whole = differing.join(ordered, ["family", "id", "digest"], "left").withColumn("many", F.size("d").cast("long"))
    excess = F.expr(f"{100 + percent} * many - {100 - percent} * n")
    return store.put(whole.select("family", "label", "id", "digest", "n", "bits", "many", F.coalesce("ordered", F.array().cast("array<struct<holders:long,s:long>>")).alias("ordered"), excess.alias("excess")), "differences")


def _rest(labelled: DataFrame, sets: DataFrame, percent: int, store: Store) -> DataFrame:
    """Pairs (a, b) of different components that hold every link between members of one bucket that no star has found."""
    rest = store.put(_mixed(labelled).select("key", "id", "label", "low"), "rest")
    found = _differences(rest, sets, percent, store)
    # Near the core: whoever is linked to anyone by excess alone is linked to the member of the least excess.
    nearest = found.groupBy("family").agg(F.min_by(F.struct("id", "label", "excess"), F.struct("excess", "id")).alias("c"))
    stars = found.join(broadcast_if_small(nearest), "family").where("excess + c.excess <= 0 and label <> c.label").select(F.greatest("id", "c.id").alias("a"), F.least("id", "c.id").alias("b"))
    # Further off: a common difference among the rarest of both. The one of less excess (x) needs at least its excess in common, the other (y) what is left
    # to it if x is as large as it may be.
    step = 100 + percent
    reach = lambda least: f"many - greatest(1, cast(ceil(({least}) / {step}D) as long)) + 1"
    sided = found.withColumn("as_x", F.expr(reach("excess"))).withColumn("as_y", F.expr(reach(f"excess - {100 - percent} * (100 * n div {percent})")))
    listed = sided.select("family", "label", "id", "n", "bits", "many", "excess", "as_x", "as_y", F.posexplode(F.slice("ordered", 1, F.greatest(F.lit(0), F.greatest("as_x", "as_y")).cast("int"))).alias("at", "o"))
    listed = store.put(listed.where("o.holders > 1").select(*listed.columns[:-2], (F.col("at") + 1).alias("at"), F.col("o.s").alias("s")), "listed")
    met = listed.groupBy("family", "s").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("family", "s")
    listed = listed.join(met, ["family", "s"])
    x, y = (listed.select("family", "s", *[F.col(c).alias(f"{side}_{c}") for c in listed.columns if c not in ("family", "s")]) for side in ("x", "y"))
    pairs = x.join(y, ["family", "s"]).where(
        "x_label <> y_label and x_at <= x_as_x and y_at <= y_as_y and (x_excess < y_excess or x_excess = y_excess and x_id < y_id)"
        f" and 100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)"
        f" and x_excess + y_excess <= {2 * step} * (1 + least(x_many - x_at, y_many - y_at))"
        f" and {step} * {_apart('x_bits', 'y_bits')} <= {100 - percent} * (x_n + y_n)"
    )
    return stars.union(pairs.select(F.greatest("x_id", "y_id").alias("a"), F.least("x_id", "y_id").alias("b"))).where("a <> b").distinct()


def near_duplicates(
    df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", store: Store | None = None
) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable over links, itself included), kept (it is that id).

    A caller that gives its own ``store`` may clear it once the result is written.
    """
    spark = df.sparkSession
    store = store or Store(spark, "near")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = store.put(batches_of(spark, rows, sign_batches(width, band_rows(percent)), "doc_id long, n long, digest binary, bands array<long>"), "signed")
    classes = store.put(
        signed.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes"
    )
    banded = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key")
    members = store.put(banded.join(shared, "key"), "members")
    wanted = store.put(members.select(F.col("id").alias("doc_id")).distinct(), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    texts = rows.join(F.broadcast(wanted) if few else wanted, "doc_id")
    sets = store.put(batches_of(spark, texts, set_batches(width), SETS_DDL), "sets")

    sketches = store.put(sets.select("id", "n", "bits"), "sketches")

    found, labelled = None, members.withColumn("label", F.col("id"))
    for number in range(ROUNDS + 1):
        if number < ROUNDS:
            pairs = labelled.join(_centres(labelled, number), "key").where("label <> centre_label")
            pairs = pairs.select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct()
        else:
            pairs = _rest(labelled, sets, percent, store)
        new = store.put(confirmed(pairs, sets, sketches, percent), f"links-{number}")
        if not new.isEmpty():
            found = components(new if found is None else found.union(new), store, f"stars-{number}")
            labelled = members.join(found.select(F.col("a").alias("id"), F.col("b").alias("label")), "id", "left").withColumn("label", F.coalesce("label", "id"))
    store.drop("members", "wanted", "sets", "sketches", "rest", "family-of", "held", "family-sizes", "cores", "differing", "differences", "listed", *[f"links-{k}" for k in range(ROUNDS + 1)])
    named = classes.select("digest", F.col("id").alias("rep"))
    if found is not None:
        named = named.join(found.select(F.col("a").alias("rep"), F.col("b").alias("label")), "rep", "left").select("digest", F.coalesce("label", "rep").alias("component_id"))
    else:
        named = named.select("digest", F.col("rep").alias("component_id"))
    some = signed.where("n > 0").select("doc_id", "n", "digest").join(named, "digest", "left").select("doc_id", "n", "component_id")
    none = signed.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return some.union(none).select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
