"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

A batch's distinct pre-tokens are held as ragged numpy arrays: one flat array of symbols, one of the ranks of neighbouring pairs, and where each
sequence starts. A round finds the lowest rank of every sequence, merges that pair wherever it stands in its sequence, and renews only the ranks
beside a merge. A sequence leaves the arrays when no pair of it is in the vocabulary; its surviving symbols are its tokens.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Special strings inside a text are one token each, as the library reads them by
default. Texts are read whole; memory is bounded by Arrow batches of a few MB, the longest text, and ``CACHE`` remembered pre-tokens. Repeated rows
stay separate rows; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from riskmart.llm.common import batches_of, record, text_pieces

#: Pre-tokens a worker remembers with their counts; when more are known it starts anew. Bounds memory, not results.
CACHE = 400_000
NO_PAIR = np.int32(2**31 - 1)
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
#: Fixed value: how the byte-level vocabulary splits a text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: itself if it prints, else the next free one from U+0100."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


class Merges:
    """Vocabulary in arrays: byte symbols, sorted pair keys, their ranks and what they merge into."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        self.special = [x["content"] for x in content["added_tokens"]]
        self.bytes = np.array([ids[c] for c in byte_letters()], dtype=np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in content["model"]["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.into = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_PAIR)

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Surviving symbols of each byte string."""
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        out = lengths.copy()
        live = np.flatnonzero(lengths > 1)
        symbols = self.bytes[np.frombuffer(b"".join(tokens[i] for i in live), dtype=np.uint8)]
        sizes = lengths[live]
        owner = np.repeat(np.arange(len(live)), sizes)
        ranks = np.full(len(symbols), NO_PAIR, dtype=np.int32)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inner] = self.pair_ranks(symbols[inner], symbols[inner + 1])
        while len(live):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NO_PAIR
            if done.any():
                out[live[done]] = sizes[done]
                stay = np.repeat(~done, sizes)
                symbols, ranks = symbols[stay], ranks[stay]
                live, sizes, lowest = live[~done], sizes[~done], lowest[~done]
                if not len(live):
                    break
            owner = np.repeat(np.arange(len(live)), sizes)
            at = np.flatnonzero(ranks == lowest[owner])
            # Of overlapping pairs (a run of one symbol) every second merges, from the left.
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.into[ranks[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            sizes = sizes - np.bincount(owner[at], minlength=len(live))
            place = np.cumsum(keep) - 1
            symbols, ranks, owner, at = symbols[keep], ranks[keep], owner[keep], place[at]
            beside = np.unique(np.concatenate([at, at - 1]))
            beside = beside[beside >= 0]
            inside = (beside + 1 < len(symbols)) & (owner[beside] == owner[np.minimum(beside + 1, len(symbols) - 1)])
            ranks[beside] = NO_PAIR
            beside = beside[inside]
            ranks[beside] = self.pair_ranks(symbols[beside], symbols[beside + 1])
        return out


@cache
def merges(path: str) -> Merges:
    return Merges(path)


class _Numbered(dict):
    def __missing__(self, token: str) -> int:
        self[token] = at = len(self)
        return at


def count_batches(path: str):
    """The task: Arrow batches of (doc_id, text) to counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, split = merges(path), regex.compile(PRE_TOKENS).findall
        special = regex.compile("|".join(regex.escape(s) for s in sorted(model.special, key=len, reverse=True)))
        known, counts = _Numbered(), np.zeros(0, np.int64)
        for batch in batches:
            for piece in text_pieces(batch):
                if len(known) > CACHE:
                    known, counts = _Numbered(), np.zeros(0, np.int64)
                number, texts = known.__getitem__, piece.column("text").to_pylist()
                extra, numbered = [], []
                for text in texts:
                    parts = special.split(text) if text else [""]
                    extra.append(len(parts) - 1)
                    numbered.append(np.concatenate([np.fromiter(map(number, split(part)), dtype=np.int32) for part in parts]))
                if len(known) > len(counts):
                    fresh = list(known)[len(counts) :]
                    counts = np.concatenate([counts, model.counts([t.encode() for t in fresh])])
                totals = [int(counts[ids].sum()) + n for ids, n in zip(numbered, extra, strict=True)]
                sizes = pc.fill_null(pc.binary_length(piece.column("text")), 0)
                yield record(SCHEMA, [piece.column("doc_id"), sizes.cast(pa.int64()), totals])

    return run


def token_counts(df: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row. ``vocabulary``: path of the tokenizer file on every executor."""
    rows = df.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    counted = batches_of(df.sparkSession, rows, count_batches(vocabulary), "doc_id long, n_bytes long, n_tokens long")
    return counted.selectExpr(f"doc_id as `{id_col}`", "n_bytes", "n_tokens", f"n_tokens > {int(limit)} as over_limit")
