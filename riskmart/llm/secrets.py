"""Secret scan: fixed base patterns, and a character convolutional network over every candidate with its context.

Pass 1 reads every whole text once: it finds the base spans and all candidates, and writes them with the characters around them. The network is
trained in numpy on all distinct labelled findings, part by part, and averaged by Spark in every round (a candidate that touches a base span is a secret, any other is not; positives are also
shown with their characters drawn anew from other alphabets; the few negatives the network doubts most are left out of later epochs). Its score is calibrated on held-back findings. The threshold keeps the wanted
recall there: it is the highest that does, or, if that lies above nearly all held-back negatives, midway to them (``NOISE``: the share of negatives that
may be secrets nobody labelled). Pass 2 scores every stored candidate that is not wholly inside a base span; those at or above the threshold are added
as ``model`` spans.

Candidates are runs of 8 or more token characters, dots included, but for runs of ordinary words: letters alone, all small, all capital or with a capital
first, of less than ``WORD_LENGTH`` letters each.

Defined cases: a null or empty text has no spans. Spans are counted in code points, end exclusive. Without any labelled finding of either kind no
network is trained and only base spans are returned. Repeated rows stay separate rows with equal spans; an empty table gives an empty result;
columns beside id and text are not carried. Candidates of any length are scored, in overlapping windows; the highest window counts.
"""

from __future__ import annotations

import copy
import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import Store, batches_of, byte_class, lower_ascii, record, text_bytes, text_pieces, word_spans

KINDS = ("assign", "access", "hex", "model")
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=](?:[A-Za-z0-9+/_.=-]{6,}[A-Za-z0-9+/_=])", re.A)
#: Runs of fewer letters are words, not keys.
WORD_LENGTH = 20
_WORDS = re.compile(rf"(?:(?:[A-Z]?[a-z]{{0,{WORD_LENGTH - 2}}}|[A-Z]{{0,{WORD_LENGTH - 1}}})(?:[+/_.=-]+|$))*", re.A)
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_BYTES = byte_class((0x30, 0x39), (0x61, 0x66))
_RUN_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x2B, 0x2B), (0x2D, 0x2F), (0x5F, 0x5F), (0x3D, 0x3D))
_DIGITS, _CAPITALS, _SMALL = byte_class((0x30, 0x39)), byte_class((0x41, 0x5A)), byte_class((0x61, 0x7A))

CONTEXT, WIDTH, STRIDE = 16, 72, 40
SYMBOLS = 99  # 0 is padding, 1-95 printable ASCII, then controls, other letters, other
#: Findings of a part, about: parts are trained side by side and averaged.
PART_ROWS = 8192
#: Held-back logits are counted in steps of 1 / GRID.
GRID = 1024
NOISE = 0.05
FOUND = pa.schema([
    ("doc_id", pa.int64()), ("base", pa.list_(pa.struct([("kind", pa.int8()), ("s", pa.int64()), ("e", pa.int64())]))),
    ("cands", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("known", pa.bool_()), ("inside", pa.bool_()), ("x", pa.binary())]))),
])
FOUND_DDL = "doc_id long, base array<struct<kind: tinyint, s: long, e: long>>, cands array<struct<s: long, e: long, known: boolean, inside: boolean, x: binary>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by start and then kind."""
    spans = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(2, *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return np.select([(points >= 32) & (points < 127), points < 32, points < 0x250], [points - 31, 96, 97], 98).astype(np.uint8)


def windows_of(text: str, start: int, end: int) -> bytes:
    """Windows of ``WIDTH`` symbols over a candidate and its context; the high bit marks the candidate's own characters."""
    low, high = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
    codes = _codes(text[low:high])
    codes[start - low : end - low] |= 128
    codes = np.concatenate([np.zeros(CONTEXT - (start - low), np.uint8), codes, np.zeros(CONTEXT - (high - end), np.uint8)])
    count = 1 + max(0, -(-(len(codes) - WIDTH) // STRIDE))
    padded = np.zeros((count - 1) * STRIDE + WIDTH, np.uint8)
    padded[: len(codes)] = codes
    return np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[::STRIDE].tobytes()


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Runs that may be keys. ``known``: it touches a base span, ``inside``: it is wholly in one."""
    out, begins = [], [s for _, s, _ in base]
    reached = list(accumulate((e for _, _, e in base), max))
    for m in CANDIDATE.finditer(text):
        if not _WORDS.fullmatch(m[0]):
            before, within = bisect_left(begins, m.end()), bisect_right(begins, m.start())
            known = before > 0 and reached[before - 1] > m.start()
            inside = within > 0 and reached[within - 1] >= m.end()
            out.append({"s": m.start(), "e": m.end(), "known": known, "inside": inside, "x": windows_of(text, *m.span())})
    return out


def _suspects(texts: pa.Array) -> np.ndarray:
    """Texts that can hold a base span or a candidate: exact necessary conditions, tested on the bytes of all texts at once."""
    data, starts = text_bytes(texts)
    flags = np.zeros(len(texts), dtype=bool)

    def mark(positions: np.ndarray) -> None:
        flags[np.searchsorted(starts, positions, side="right") - 1] = True

    begins, ends, _ = word_spans(data, starts, _HEX_BYTES)
    mark(begins[ends - begins >= 24])
    begins, ends, _ = word_spans(data, starts, _RUN_BYTES)
    long = ends - begins >= 8
    begins, ends = begins[long], ends[long]
    small, capital = _SMALL[data], _CAPITALS[data]
    odd = _DIGITS[data].copy()  # a digit, a capital after a small letter, a small letter after two capitals
    odd[1:] |= capital[1:] & small[:-1]
    odd[2:] |= small[2:] & capital[1:-1] & capital[:-2]
    sums = np.concatenate([[0], np.cumsum(odd, dtype=np.int32)])
    mark(begins[sums[ends] > sums[begins]])
    begins, ends, _ = word_spans(data, starts, _SMALL | _CAPITALS)
    mark(begins[ends - begins >= WORD_LENGTH])
    for whole, words in ((lower_ascii(data).tobytes(), KEYWORDS), (data.tobytes(), (b"AKIA",))):
        for word in words:
            at = whole.find(word)
            while at >= 0:
                mark(np.array([at]))
                at = whole.find(word, at + 1)
    return flags


def find_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in text_pieces(batch):
            column = piece.column("text")
            base: list[list] = [[] for _ in range(len(column))]
            cands: list[list] = [[] for _ in range(len(column))]
            for i in np.flatnonzero(_suspects(column)):
                text = column[int(i)].as_py()
                spans = base_spans(text)
                base[i] = [{"kind": k, "s": s, "e": e} for k, s, e in spans]
                cands[i] = candidates(text, spans)
            yield record(FOUND, [piece.column("doc_id"), base, cands])


@dataclass
class CharNet:
    """Embedding, one convolution with ReLU, maximum and mean over positions, two dense layers; plus calibration and threshold."""

    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0
    #: Share of held-back positives at or above the threshold.
    recall: float = 0.0

    WIDE, EMBED, FILTERS, HIDDEN = 5, 6, 16, 12

    @classmethod
    def start(cls, seed: int) -> CharNet:
        draw = np.random.default_rng(seed)
        of = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        return cls({
            "emb": draw.standard_normal((SYMBOLS, cls.EMBED)).astype(np.float32) * 0.5, "conv": of(cls.WIDE * (cls.EMBED + 1), cls.FILTERS),
            "cb": np.zeros(cls.FILTERS, np.float32), "w1": of(2 * cls.FILTERS, cls.HIDDEN), "b1": np.zeros(cls.HIDDEN, np.float32),
            "w2": of(cls.HIDDEN, 1), "b2": np.zeros(1, np.float32),
        })

    def forward(self, codes: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        symbols, own = np.minimum(codes & 127, SYMBOLS - 1), (codes >> 7).astype(np.float32)
        x = np.concatenate([w["emb"][symbols], own[:, :, None]], axis=2)
        n, length, depth = x.shape
        cols = np.lib.stride_tricks.sliding_window_view(x, self.WIDE, axis=1).transpose(0, 1, 3, 2).reshape(n, length - self.WIDE + 1, self.WIDE * depth)
        act = np.maximum(cols @ w["conv"] + w["cb"], 0)
        pooled = np.concatenate([act.max(axis=1), act.mean(axis=1)], axis=1)
        hidden = np.tanh(pooled @ w["w1"] + w["b1"])
        return {"symbols": symbols, "cols": cols, "act": act, "pooled": pooled, "hidden": hidden, "z": (hidden @ w["w2"] + w["b2"])[:, 0]}

    def gradients(self, codes: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(codes)
        dz = ((1 / (1 + np.exp(-f["z"])) - label) / len(label)).astype(np.float32)[:, None]
        dh = dz @ w["w2"].T * (1 - f["hidden"] ** 2)
        dp = dh @ w["w1"].T
        act = f["act"]
        da = np.repeat((dp[:, self.FILTERS :] / act.shape[1])[:, None, :], act.shape[1], axis=1)
        top = act.argmax(axis=1)
        np.add.at(da, (np.arange(len(act))[:, None], top, np.arange(self.FILTERS)[None, :]), dp[:, : self.FILTERS])
        da *= act > 0
        flat = da.reshape(-1, self.FILTERS)
        dc = (flat @ w["conv"].T).reshape(*act.shape[:2], self.WIDE, self.EMBED + 1)
        demb = np.zeros_like(w["emb"])
        for k in range(self.WIDE):
            np.add.at(demb, f["symbols"][:, k : k + act.shape[1]], dc[:, :, k, : self.EMBED])
        return {
            "emb": demb, "conv": f["cols"].reshape(-1, f["cols"].shape[2]).T @ flat, "cb": flat.sum(axis=0), "w1": f["pooled"].T @ dh,
            "b1": dh.sum(axis=0), "w2": f["hidden"].T @ dz, "b2": dz.sum(axis=0),
        }

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(codes[i : i + 512])["z"] for i in range(0, len(codes), 512)] or [np.zeros(0, np.float32)])

    def scores(self, blobs: list[bytes]) -> np.ndarray:
        """Calibrated probability of each candidate: that of its highest window."""
        counts = np.array([len(b) // WIDTH for b in blobs], dtype=np.int64)
        if not len(counts):
            return np.zeros(0)
        z = self.logits(np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, WIDTH))
        best = np.maximum.reduceat(z, np.cumsum(counts) - counts).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(self.scale * best + self.shift, -50, 50)))


def _redrawn(codes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Positives with their own characters from another alphabet, half of them shortened, half without their context."""
    alphabets = ["0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]
    out = codes.copy()
    for row in out:
        letters = _codes(alphabets[draw.integers(len(alphabets))])
        own = row >= 128
        row[own] = letters[draw.integers(0, len(letters), own.sum())] | 128
        if draw.random() < 0.5 and own.sum() > 8:
            row[np.flatnonzero(own)[draw.integers(8, own.sum()) :]] = 1
        if draw.random() < 0.5:
            row[~own & (row > 0)] = 1
    return out


@dataclass
class Steps:
    """Weights on their way, with the moments of Adam; as one vector they are averaged over the parts of the findings."""

    net: CharNet
    mean: dict[str, np.ndarray]
    square: dict[str, np.ndarray]
    step: int = 0

    @classmethod
    def start(cls, seed: int) -> Steps:
        net = CharNet.start(seed)
        zeros = lambda: {k: np.zeros_like(v) for k, v in net.weights.items()}
        return cls(net, zeros(), zeros())

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for part in (self.net.weights, self.mean, self.square) for v in part.values()]).astype(np.float64)

    def put(self, vector: np.ndarray) -> None:
        at = 0
        for part in (self.net.weights, self.mean, self.square):
            for k, v in part.items():
                part[k] = vector[at : at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size

    def run(self, pos: np.ndarray, neg: np.ndarray, epochs: range, draw: np.random.Generator) -> None:
        x = np.concatenate([pos, _redrawn(pos, draw), neg])
        y = np.concatenate([np.ones(2 * len(pos)), np.zeros(len(neg))]).astype(np.float32)
        net = self.net
        for epoch in epochs:
            order = draw.permutation(len(x))
            if epoch >= 2 and len(neg):  # the negatives it doubts most may be secrets: they teach nothing
                doubt = net.logits(neg)
                doubted = np.flatnonzero((doubt > -1) & (doubt >= np.quantile(doubt, 1 - NOISE))) + len(x) - len(neg)
                order = order[~np.isin(order, doubted)]
            for at in range(0, len(order), 128):
                self.step += 1
                pick = order[at : at + 128]
                for k, g in net.gradients(x[pick], y[pick]).items():
                    self.mean[k] += 0.1 * (g - self.mean[k])
                    self.square[k] += 0.001 * (g * g - self.square[k])
                    net.weights[k] -= 0.004 * (self.mean[k] / (1 - 0.9**self.step)) / (np.sqrt(self.square[k] / (1 - 0.999**self.step)) + 1e-8)


def _epochs(epochs: int, rows: int, steps: int = 150) -> int:
    return max(epochs, -(-steps * 128 // max(rows, 1)))


def settle(net: CharNet, z: np.ndarray, label: np.ndarray, count: np.ndarray, recall: float) -> CharNet:
    """Calibration and threshold from held-back findings, counted by logit (in steps of 1 / ``GRID``, rounded down) and label."""
    order = np.argsort(z, kind="stable")
    z, label, count = z[order], label[order], count[order].astype(np.float64)
    for _ in range(200):  # scale and shift by gradient steps on the held-back findings
        p = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -50, 50)))
        net.scale = max(0.05, net.scale - 0.05 * float(np.average((p - label) * z, weights=count)))
        net.shift -= 0.2 * float(np.average(p - label, weights=count))
    p = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -50, 50)))

    def at_rank(which: np.ndarray, share: float) -> float:
        reached = np.cumsum(count[which])
        return float(p[which][np.searchsorted(reached, int(share * reached[-1]), side="right").clip(max=which.sum() - 1)])

    bound, clean = at_rank(label == 1, 1 - recall), at_rank(label == 0, 1 - NOISE)
    net.threshold = bound if clean >= bound else (bound + clean) / 2
    net.recall = float(count[(label == 1) & (p >= net.threshold)].sum() / count[label == 1].sum())
    return net


def _on_grid(z: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(z, -50, 50) * GRID).astype(np.int64)


def fit(positive: list[bytes], negative: list[bytes], recall: float = 0.99, epochs: int = 12, seed: int = 7) -> CharNet | None:
    """Findings in memory: trained on three quarters of them; calibrated, with the threshold set, on the rest, without the redrawn ones."""
    if len(positive) < 8 or len(negative) < 8:
        return None
    first = lambda blobs: np.stack([np.frombuffer(b[:WIDTH], np.uint8) for b in blobs])
    pos, neg = first(positive), first(negative)
    held = [pos[: len(pos) // 4], neg[: len(neg) // 4]]
    pos, neg = pos[len(pos) // 4 :], neg[len(neg) // 4 :]
    steps = Steps.start(seed)
    steps.run(pos, neg, range(_epochs(epochs, 2 * len(pos) + len(neg))), np.random.default_rng(seed))
    z = _on_grid(steps.net.logits(np.concatenate(held))) / GRID
    return settle(steps.net, z, np.repeat([1, 0], [len(held[0]), len(held[1])]), np.ones(len(z)), recall)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0])))


SCANNED = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_model", pa.int64()),
    ("base_sha256", pa.string()), ("spans", pa.string()),
])


def score_batches(net: CharNet | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, cands = batch.column("base").to_pylist(), batch.column("cands").to_pylist()
            new = [(i, c) for i, cs in enumerate(cands) for c in cs if not c["inside"]]
            scores = net.scores([c["x"] for _, c in new]) if net else np.zeros(len(new))
            added: dict[int, list] = {}
            for (i, c), score in zip(new, scores, strict=True):
                if net and score >= net.threshold:
                    added.setdefault(i, []).append((3, c["s"], c["e"]))
            spans = [[(x["kind"], x["s"], x["e"]) for x in row] for row in base]
            count = lambda kind: [sum(k == kind for k, _, _ in row) for row in spans]
            yield record(SCANNED, [
                batch.column("doc_id"), count(0), count(1), count(2), [len(added.get(i, ())) for i in range(len(spans))],
                [hashlib.sha256(span_text(row).encode()).hexdigest() for row in spans],
                [span_text(row + added.get(i, [])) for i, row in enumerate(spans)],
            ])

    return run


def _blobs(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def _round(steps: Steps, epochs: range, seed: int):
    """One part runs ``epochs`` from the common weights; its vector, weighted by its rows."""

    def run(findings: pa.Table) -> pa.Table:
        findings = findings.sort_by("x")
        codes, known, part = _blobs(findings.column("x")), findings.column("known").to_numpy(), findings.column("part")[0].as_py()
        mine = copy.deepcopy(steps)
        mine.run(codes[known], codes[~known], epochs, np.random.default_rng((seed, part, epochs.start)))
        vector, n = mine.vector(), len(codes)
        return pa.table({"number": pa.array(np.arange(len(vector)), pa.int32()), "value": vector * n, "rows": np.full(len(vector), n, np.int64),
                         "step": np.full(len(vector), mine.step, np.int64)})

    return run


def _logit_batches(net: CharNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = net.logits(_blobs(batch.column("x"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("known"), pa.array(_on_grid(z))], ["known", "z"])

    return run


def trained(found: DataFrame, store: Store, recall: float = 0.99, epochs: int = 12, seed: int = 7, part_rows: int = PART_ROWS) -> CharNet | None:
    """Fitted on all distinct findings. They are dealt by hash to parts of about ``part_rows``; in every round each part runs an epoch from the common
    weights, and Spark averages what comes out. One finding in four is held back: calibration and threshold come from the counts of all of those
    by logit. Only weights and counts reach the driver; a single part runs all epochs in one round."""
    spark = found.sparkSession
    each = found.select("doc_id", F.explode("cands").alias("c")).select("c.known", F.substring("c.x", 1, WIDTH).alias("x"))
    findings = store.put(each.distinct().withColumn("h", F.xxhash64("x")), "findings")
    held = F.pmod(F.col("h"), F.lit(4)) == 0
    sizes = {(r.known, r.held): r["count"] for r in findings.groupBy("known", held.alias("held")).count().collect()}
    of = lambda known: sizes.get((known, False), 0) + sizes.get((known, True), 0)
    if of(True) < 8 or of(False) < 8:
        return None
    apart = len(sizes) == 4  # each label on both sides; else the few findings serve for both
    learnt, judged = (findings.where(~held), findings.where(held)) if apart else (findings, findings)
    pos, neg = (sizes[k, False] if apart else of(k) for k in (True, False))
    parts = -(-(pos + neg) // part_rows)
    dealt = learnt.select("known", "x", F.pmod(F.shiftright("h", 2), F.lit(parts)).cast("int").alias("part"))
    dealt = dealt.repartition(parts, "part")  # a fixed count: small parts are not merged into one task
    steps, total = Steps.start(seed), _epochs(epochs, (2 * pos + neg) // parts, 150 if parts == 1 else 400)
    for first in range(0, total, total if parts == 1 else 1):
        turn = range(first, total if parts == 1 else first + 1)
        ran = dealt.groupBy("part").applyInArrow(_round(steps, turn, seed), "number int, value double, rows long, step long")
        summed = ran.groupBy("number").agg((F.sum("value") / F.sum("rows")).alias("value"), F.max("step").alias("step")).orderBy("number").collect()
        steps.put(np.array([r.value for r in summed]))
        steps.step = summed[0].step
    logits = batches_of(spark, judged.select("known", "x"), _logit_batches(steps.net), "known boolean, z long")
    counts = logits.groupBy("known", "z").count().collect()  # at most 2 * 100 * GRID
    z, label, count = (np.array([r[k] for r in counts]) for k in ("z", "known", "count"))
    return settle(steps.net, z / GRID, label.astype(np.int64), count, recall)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spark = df.sparkSession
    rows = df.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    store = Store(spark, "secrets")
    found = store.put(batches_of(spark, rows, find_batches, FOUND_DDL), "found")
    ddl = "doc_id long, n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string"
    return batches_of(spark, found, score_batches(trained(found, store)), ddl).withColumnRenamed("doc_id", id_col)
