"""Quality classifier: random-indexing word vectors pooled by document, and a two-layer network in numpy.

Words are runs of letters, of digits or of signs, hashed to ``BUCKETS`` places; each also has a shape (class, capitals, length, how soon it is
repeated) with a place of its own. A place has a fixed sparse ternary index vector. The context vector of a place is the sum of the index vectors
around all its occurrences in all documents: partial sums in each task, added up by Spark, integers throughout, so that partitioning cannot change
them. The result has BUCKETS x (DIMENSIONS + 1) numbers however large the corpus is; that bound is what allows it to reach every task.
A document is the mean of its words' and of its shapes' context vectors; the network is fitted on at most ``TRAIN_DOCS`` labelled
documents (the first in hash order), and its temperature on a held-back fifth of them.

Defined cases: a null or empty text is a document without words (all means 0) and gets the score of that. Without labels of both classes every score
is the share of label 1 (0.5 without labels). Conflicting labels of one document both count. Repeated rows stay separate rows; an empty table gives
an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import batches_of, crc_mod, first_in_hash_order, record, span_hashes, text_bytes, text_pieces

BUCKETS, SHAPES, DIMENSIONS = 1 << 14, 256, 24
REACH, NONZERO = 2, 4
TRAIN_DOCS = 8000
PIECE = 1 << 20

_CLASS = np.full(256, 3, dtype=np.int8)  # 0 space, 1 letter or beyond ASCII, 2 digit, 3 sign
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1


def index_vectors(seed: int = 5) -> np.ndarray:
    """(dimension, place): ``NONZERO`` entries of +1 or -1; the last place, which pads between documents, has none."""
    draw = np.random.default_rng(seed)
    out = np.zeros((DIMENSIONS, BUCKETS + 1), dtype=np.float32)
    rows = np.argsort(draw.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    out[rows, np.arange(BUCKETS)[:, None]] = draw.choice([-1.0, 1.0], size=(BUCKETS, NONZERO))
    return out


def places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word place and shape place of every word of all texts, and the number of words of each text."""
    data, starts = text_bytes(texts)
    kind = _CLASS[data]
    first = np.ones(len(data), dtype=bool)
    first[1:] = kind[1:] != kind[:-1]
    cuts = starts[1:-1]
    first[cuts[cuts < len(data)]] = True
    edges = np.flatnonzero(first)
    ends = np.append(edges[1:], len(data))
    real = kind[edges] != 0
    begins, ends = edges[real], ends[real]
    counts = np.diff(np.searchsorted(begins, starts))
    hashes = span_hashes(data, begins, ends)
    capitals = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    n_capitals, length = capitals[ends] - capitals[begins], ends - begins
    case = np.where(n_capitals == 0, 0, np.where((n_capitals == 1) | (2 * n_capitals < length), 1, 2))
    owner = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(hashes), dtype=np.int64)
    for k in range(4, 0, -1):
        again[k:][(hashes[k:] == hashes[:-k]) & (owner[k:] == owner[:-k])] = k
    shape = ((kind[begins].astype(np.int64) - 1) * 3 + case) * 20 + np.minimum((length - 1) // 2, 3) * 5 + again
    return (hashes % np.uint64(BUCKETS - SHAPES)).astype(np.int64), shape + (BUCKETS - SHAPES), counts


CONTEXT_DDL = "place int, n long, " + ", ".join(f"c{j} long" for j in range(DIMENSIONS))


def context_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's partial sums: how often each place occurs and the index vectors around it."""
    index = index_vectors()
    seen, sums = np.zeros(BUCKETS), np.zeros((DIMENSIONS, BUCKETS))
    for batch in batches:
        for piece in text_pieces(batch, PIECE):
            word, shape, counts = places(piece.column("text"))
            if not len(word):
                continue
            at = np.arange(len(word)) + REACH * (1 + np.repeat(np.arange(len(counts)), counts))
            wide = np.full((2, at[-1] + REACH + 1), BUCKETS, dtype=np.int64)
            wide[0, at], wide[1, at] = word, shape
            seen += np.bincount(word, minlength=BUCKETS) + np.bincount(shape, minlength=BUCKETS)
            for j in range(DIMENSIONS):
                near = index[j][wide[0]] + index[j][wide[1]]
                around = sum(near[at + k] for k in range(-REACH, REACH + 1) if k)
                sums[j] += np.bincount(word, weights=around, minlength=BUCKETS) + np.bincount(shape, weights=around, minlength=BUCKETS)
    used = np.flatnonzero(seen)
    columns = [pa.array(used, pa.int32()), pa.array(seen[used].astype(np.int64))] + [pa.array(np.rint(s[used]).astype(np.int64)) for s in sums]
    yield pa.RecordBatch.from_arrays(columns, names=["place", "n", *[f"c{j}" for j in range(DIMENSIONS)]])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(dimension, place): mean context of each place less that of the corpus, scaled to unit length. Bounded by BUCKETS x DIMENSIONS."""
    names = ["n", *[f"c{j}" for j in range(DIMENSIONS)]]
    parts = batches_of(docs.sparkSession, docs.select("text"), context_batches, CONTEXT_DDL)
    rows = parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in names]).collect()
    total = np.zeros((1 + DIMENSIONS, BUCKETS))
    for r in rows:
        total[:, r.place] = r[1:]
    seen, sums = total[0], total[1:]
    mean = sums / np.maximum(seen, 1) - (sums.sum(axis=1) / max(seen.sum(), 1))[:, None]
    mean[:, seen == 0] = 0
    return (mean / np.maximum(np.sqrt((mean**2).sum(axis=0)), 1e-9)).astype(np.float32)


def features(vectors: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Mean word vector, mean shape vector and log word count of each text."""
    word, shape, counts = places(texts)
    out = np.zeros((len(counts), 2 * DIMENSIONS + 1), dtype=np.float32)
    owner = np.repeat(np.arange(len(counts)), counts)
    for j in range(DIMENSIONS):
        for part, place in enumerate((word, shape)):
            out[:, part * DIMENSIONS + j] = np.bincount(owner, weights=vectors[j][place], minlength=len(counts)) / np.maximum(counts, 1)
    out[:, -1] = np.log1p(counts)
    return out


@dataclass
class QualityNet:
    """Standardised features, one hidden layer, one logit; ``temperature`` divides the logit."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.spread @ self.w1 + self.b1)
        return (hidden @ self.w2)[:, 0] + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 3) -> QualityNet:
    """Adam on four fifths with a little weight decay; temperature by a search over the rest's log loss."""
    width = x.shape[1]
    share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
    net = QualityNet(np.zeros(width), np.ones(width), np.zeros((width, hidden)), np.zeros(hidden), np.zeros((hidden, 1)), float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return net
    held = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
    tx, ty = x[~held].astype(np.float64), y[~held]
    net.mean, net.spread = tx.mean(axis=0), tx.std(axis=0) + 1e-3
    draw = np.random.default_rng(seed)
    p = {"w1": draw.standard_normal((width, hidden)) / np.sqrt(width), "b1": np.zeros(hidden), "w2": draw.standard_normal((hidden, 1)) / np.sqrt(hidden), "b2": np.zeros(1)}
    m, v = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    tx, step = (tx - net.mean) / net.spread, 0
    for _ in range(max(epochs, -(-1000 * 64 // len(ty)))):
        order = draw.permutation(len(ty))
        for low in range(0, len(ty), 64):
            pick = order[low : low + 64]
            step += 1
            h = np.tanh(tx[pick] @ p["w1"] + p["b1"])
            dz = ((1 / (1 + np.exp(-np.clip((h @ p["w2"])[:, 0] + p["b2"], -60, 60))) - ty[pick]) / len(pick))[:, None]
            dh = dz @ p["w2"].T * (1 - h * h)
            for k, g in (("w1", tx[pick].T @ dh + 1e-4 * p["w1"]), ("b1", dh.sum(axis=0)), ("w2", h.T @ dz + 1e-4 * p["w2"]), ("b2", dz.sum(axis=0))):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p["w1"], p["b1"], p["w2"], float(p["b2"][0])
    if held.any():
        z, t = net.logits(x[held]), y[held]
        loss = lambda c: float(np.mean(np.logaddexp(0, np.where(t == 1, -z, z) / c)))
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])


def score_batches(vectors: np.ndarray, net: QualityNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, PIECE):
                yield record(SCORED, [piece.column("doc_id"), piece.column("held_out"), net.scores(features(vectors, piece.column("text")))])

    return run


def feature_batches(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, PIECE):
                rows = [r.tobytes() for r in features(vectors, piece.column("text"))]
                yield pa.RecordBatch.from_arrays([piece.column("h"), piece.column("quality"), pa.array(rows, pa.binary())], names=["h", "quality", "x"])

    return run


def trained(rows: DataFrame, labels: DataFrame, vectors: np.ndarray, limit: int = TRAIN_DOCS) -> QualityNet:
    """Fit on the first ``limit`` labelled documents in hash order; never on a held-out one."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where((crc_mod("doc_id", 3) != 1) & F.col("quality").isin(0, 1)).distinct()
        .withColumn("h", F.xxhash64("doc_id"))
    )
    picked = first_in_hash_order(chosen, limit, "quality")
    local = rows.sparkSession.createDataFrame([(r.doc_id, r.quality, r.h) for r in picked], "doc_id long, quality int, h long")
    sample = rows.join(F.broadcast(local), "doc_id").select("h", "quality", "text")  # ``limit`` narrow rows
    found = batches_of(rows.sparkSession, sample, feature_batches(vectors), "h long, quality int, x binary").orderBy("h", "quality", "x").limit(limit).collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in found]).reshape(len(found), 2 * DIMENSIONS + 1)
    return fit(x, np.array([r.quality for r in found], dtype=np.float64))


def keep_batches(vectors: np.ndarray, net: QualityNet, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, PIECE, text_col):
                good = net.scores(features(vectors, piece.column(text_col))) >= 0.5
                yield piece.filter(pa.array(good))

    return run


def prepared(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.withColumn("held_out", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every row."""
    rows = prepared(df, id_col, text_col)
    vectors = word_vectors(rows)
    scored = batches_of(df.sparkSession, rows, score_batches(vectors, trained(rows, labels, vectors)), "doc_id long, held_out boolean, score double")
    return scored.select(F.col("doc_id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, that the classifier scores 0.5 or more."""
    rows = prepared(df, id_col, text_col)
    vectors = word_vectors(rows)
    return batches_of(df.sparkSession, df, keep_batches(vectors, trained(rows, labels, vectors), text_col), df.schema)
