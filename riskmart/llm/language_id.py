"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in windows of ``WINDOW``, left to right and right to left, and labels every position with language probabilities;
a document's probabilities are the mean over all its positions. It is trained in numpy by backpropagation through time, on windows from at most
``TRAIN_DOCS`` labelled documents (the first in hash order). A text of any length is cut into windows that cover each byte once, and windows of many
texts run as one batch, so memory does not follow the longest text.

Defined cases: a text that is null or without a letter is ``und`` with score 0. Without labelled rows nothing is learned and every row is ``und``.
Repeated rows stay separate rows with equal results; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import batches_of, crc_mod, first_in_hash_order, lower_ascii, record, text_bytes, text_pieces

WINDOW = 64
TRAIN_DOCS = 4000
EMBED, HIDDEN = 8, 8
CHUNK = 2048
PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, -1, out=x)
    np.exp(np.minimum(x, 30, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


class ByteGru:
    """One embedding, two gated recurrent passes, and a softmax over both states at each position. States are (unit, window) arrays."""

    def __init__(self, languages: list[str], seed: int = 11):
        self.languages = languages
        draw = np.random.default_rng(seed)
        of = lambda rows, cols: (draw.standard_normal((rows, cols)) / np.sqrt(cols)).astype(np.float32)
        self.w = {"emb": draw.standard_normal((EMBED, 256)).astype(np.float32) * 0.5, "out_b": np.zeros((len(languages), 1), np.float32)}
        for way in ("f", "b"):
            # Update and reset gates read state and input together; the candidate keeps them apart, as the reset gate acts on the state.
            self.w |= {
                f"{way}g": of(2 * HIDDEN, HIDDEN + EMBED), f"{way}gb": np.zeros((2 * HIDDEN, 1), np.float32), f"{way}u": of(HIDDEN, HIDDEN),
                f"{way}x": of(HIDDEN, EMBED), f"{way}xb": np.zeros((HIDDEN, 1), np.float32), f"{way}o": of(len(languages), HIDDEN),
            }

    def _step(self, way: str, h: np.ndarray, x: np.ndarray):
        w = self.w
        gates = w[f"{way}g"] @ np.concatenate([h, x])
        gates += w[f"{way}gb"]
        _sigmoid(gates)
        z, r = gates[:HIDDEN], gates[HIDDEN:]
        inner = w[f"{way}u"] @ h
        new = inner * r
        new += w[f"{way}x"] @ x
        new += w[f"{way}xb"]
        np.tanh(new, out=new)
        return (h - new) * z + new, (h, x, z, r, inner, new)

    def probabilities(self, windows: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """Sum of the position probabilities by (language, window). ``windows``: bytes (position, window); ``counted``: 0/1 weights."""
        steps, n = windows.shape
        x = self.w["emb"].take(windows, axis=1)
        half = np.empty((steps, len(self.languages), n), np.float32)
        h = np.zeros((HIDDEN, n), np.float32)
        for t in range(steps):
            h, _ = self._step("f", h, x[:, t])
            np.matmul(self.w["fo"], h, out=half[t])
        total, h = np.zeros((len(self.languages), n), np.float32), np.zeros((HIDDEN, n), np.float32)
        for t in range(steps - 1, -1, -1):
            h, _ = self._step("b", h, x[:, t])
            logits = self.w["bo"] @ h
            logits += half[t]
            logits += self.w["out_b"]
            logits -= logits.max(axis=0)
            np.exp(logits, out=logits)
            logits *= counted[t] / logits.sum(axis=0)
            total += logits
        return total

    def gradients(self, windows: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross entropy over all positions."""
        w, (steps, n) = self.w, windows.shape
        x = w["emb"].take(windows, axis=1)
        tape: dict[str, list] = {"f": [None] * steps, "b": [None] * steps}
        states: dict[str, list] = {"f": [None] * steps, "b": [None] * steps}
        for way, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            h = np.zeros((HIDDEN, n), np.float32)
            for t in order:
                h, tape[way][t] = self._step(way, h, x[:, t])
                states[way][t] = h
        g = {k: np.zeros_like(v) for k, v in w.items()}
        dx, errors = np.zeros_like(x), []
        for t in range(steps):
            logits = w["fo"] @ states["f"][t] + w["bo"] @ states["b"][t] + w["out_b"]
            logits -= logits.max(axis=0)
            p = np.exp(logits)
            p /= p.sum(axis=0)
            p[label, np.arange(n)] -= 1
            p /= n * steps
            errors.append(p)
            g["out_b"] += p.sum(axis=1, keepdims=True)
        for way, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
            back = np.zeros((HIDDEN, n), np.float32)
            for t in order:
                h, xt, z, r, inner, new = tape[way][t]
                g[f"{way}o"] += errors[t] @ states[way][t].T
                dh = back + w[f"{way}o"].T @ errors[t]
                dnew = dh * (1 - z) * (1 - new * new)
                dgates = np.concatenate([dh * (h - new) * z * (1 - z), dnew * inner * r * (1 - r)])
                dinner = dnew * r
                both = w[f"{way}g"].T @ dgates
                g[f"{way}g"] += dgates @ np.concatenate([h, xt]).T
                g[f"{way}gb"] += dgates.sum(axis=1, keepdims=True)
                g[f"{way}u"] += dinner @ h.T
                g[f"{way}x"] += dnew @ xt.T
                g[f"{way}xb"] += dnew.sum(axis=1, keepdims=True)
                back = dh * z + both[:HIDDEN] + w[f"{way}u"].T @ dinner
                dx[:, t] += both[HIDDEN:] + w[f"{way}x"].T @ dnew
        flat = windows.ravel()
        for e in range(EMBED):
            g["emb"][e] = np.bincount(flat, weights=dx[e].ravel(), minlength=256)
        return g


def window_starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of these lengths: the text of each window, where it starts in the text, and how many of its first bytes an earlier one has."""
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), counts)
    first = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * WINDOW
    start = np.minimum(first, np.maximum(lengths[owner] - WINDOW, 0))
    return owner, start, first - start


def fit(texts: list[bytes], labels: list[str], seed: int = 11, steps: int = 300, batch: int = 192) -> ByteGru | None:
    """Train on one window for each text: shorter ones are filled with spaces, as at prediction."""
    if not texts:
        return None
    languages = sorted(set(labels))
    net = ByteGru(languages, seed)
    data = np.full((len(texts), WINDOW), 0x20, np.uint8)
    for row, text in zip(data, texts, strict=True):
        row[: len(text)] = np.frombuffer(text[:WINDOW], np.uint8)
    data = lower_ascii(data)
    label = np.searchsorted(languages, labels)
    draw = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in net.w.items()}
    square = {k: np.zeros_like(v) for k, v in net.w.items()}
    for step in range(1, steps + 1):
        pick = draw.integers(0, len(data), batch)
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k, g in net.gradients(np.ascontiguousarray(data[pick].T), label[pick]).items():
            g = np.clip(g, -1, 1)
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            net.w[k] -= (rate * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def pooled(net: ByteGru, texts: pa.Array) -> np.ndarray:
    """Mean position probabilities, (text, language); zeros for an empty text."""
    data, starts = text_bytes(texts)
    data = np.append(lower_ascii(data), np.uint8(0x20))
    lengths = np.diff(starts)
    owner, start, seen = window_starts(lengths)
    total = np.zeros((len(lengths), len(net.languages)))
    at = np.arange(WINDOW)[:, None]
    for low in range(0, len(owner), CHUNK):
        own, begin, skip = owner[low : low + CHUNK], start[low : low + CHUNK], seen[low : low + CHUNK]
        inside = at < (lengths[own] - begin)
        windows = data[np.where(inside, at + (starts[own] + begin), len(data) - 1)]
        sums = net.probabilities(windows, (inside & (at >= skip)).astype(np.float32))
        for k in range(len(net.languages)):
            total[:, k] += np.bincount(own, weights=sums[k], minlength=len(lengths))
    return total / np.maximum(lengths, 1)[:, None]


def predict_batches(net: ByteGru | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has_letter = regex.compile(r"\p{L}").search
        for batch in batches:
            for piece in text_pieces(batch, 1 << 21):
                column = piece.column("text")
                letters = np.array([bool(t) and has_letter(t) is not None for t in column.to_pylist()], dtype=bool)
                if net is None:
                    names, scores = ["und"] * len(column), [0.0] * len(column)
                else:
                    p = pooled(net, column)
                    best = p.argmax(axis=1) if len(column) else np.zeros(0, int)
                    names = [net.languages[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
                    scores = np.where(letters, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)
                yield record(PREDICTED, [piece.column("doc_id"), piece.column("held_out"), names, scores])

    return run


def trained(df: DataFrame, limit: int = TRAIN_DOCS) -> ByteGru | None:
    """Fit on the labelled rows of ``df`` (text, lang): a window from somewhere in each of the first ``limit`` documents in hash order."""
    place = F.xxhash64("doc_id", F.lit(1))
    text = F.coalesce("text", F.lit(""))
    begin = F.lit(1) + F.pmod(place, F.greatest(F.lit(1), F.length(text) - F.lit(WINDOW - 1)).cast("long")).cast("int")
    labelled = df.where("lang is not null").select(place.alias("h"), "doc_id", "lang", text.substr(begin, F.lit(WINDOW)).alias("w"))
    rows = [r for r in first_in_hash_order(labelled, limit, "doc_id", "w", "lang") if r.w]
    return fit([r.w.encode() for r in rows], [r.lang for r in rows])


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predict every row; learn from the labelled rows whose crc32(id as text) mod 4 is not 2."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).withColumn("held_out", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)))
    net = trained(rows.where("not held_out"))
    found = batches_of(df.sparkSession, rows.select("doc_id", "held_out", "text"), predict_batches(net), "doc_id long, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("doc_id", id_col)
