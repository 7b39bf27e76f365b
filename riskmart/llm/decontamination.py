"""Benchmark decontamination over a distributed positional inverted index.

The index is split by document: each task turns the documents it reads into segments, written as Parquet. A segment numbers the words of its
documents one after another (one number stays free between two documents, so that no phrase can cross them) and holds, for every term, the sorted
numbers where it stands. Any set of test items is then searched segment by segment, without a shuffle: the lists of a window's words, moved
by their offset in the window, are intersected from the rarest. With ``misses`` > 0 the same lists give proximity matches: windows in which at most that
many words differ at their offset. Such a window agrees on one of its ``misses`` + 1 rarest words at least, so those lists hold all its candidates.

Test items are read in blocks of ``BLOCK_BYTES`` of text at most; a task holds one block and one segment. Terms are 64-bit hashes of words.

Defined cases: a null or empty text has no words, is never hit and never contaminated. An item without words has no window; an item with fewer than
``WINDOW`` words is one window and has no proximity match; a null item id reads as an empty string. Items with one id count once. Repeated documents
stay separate rows. Empty tables give empty results or documents without hits. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import Store, batches_of, byte_class, lower_ascii, record, span_hashes, text_bytes, text_pieces, word_spans

WINDOW = 13
BLOCK_BYTES = 16 * 1024 * 1024
SEGMENT_BYTES = 2 * 1024 * 1024
_WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
SEGMENT = pa.schema([
    ("segment", pa.int64()), ("doc_ids", pa.binary()), ("null_ids", pa.binary()), ("doc_starts", pa.binary()), ("terms", pa.binary()),
    ("term_starts", pa.binary()), ("postings", pa.binary()),
])
SEGMENT_DDL = "segment long, doc_ids binary, null_ids binary, doc_starts binary, terms binary, term_starts binary, postings binary"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term of every word of all texts, and the number of words of each text."""
    data, starts = text_bytes(texts)
    data = lower_ascii(data)
    begins, ends, counts = word_spans(data, starts, _WORD)
    return span_hashes(data, begins, ends), counts


def segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32 if TaskContext.get() else 0
    for batch in batches:
        for piece in text_pieces(batch, SEGMENT_BYTES):
            terms, counts = words_of(piece.column("text"))
            starts = np.concatenate([[0], np.cumsum(counts + 1)])
            at = (np.arange(len(terms)) + np.repeat(np.arange(len(counts)), counts)).astype(np.uint32)
            order = np.argsort(terms, kind="stable")
            ordered = terms[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
            ids = piece.column("doc_id")
            yield record(SEGMENT, [[x] for x in (
                number, np.asarray(ids.fill_null(0)).astype(np.int64).tobytes(), np.asarray(ids.is_null()).tobytes(), starts.astype(np.int64).tobytes(),
                ordered[first].tobytes(), np.append(first, len(ordered)).astype(np.int64).tobytes(), at[order].tobytes(),
            )])
            number += 1


def index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", store: Store | None = None) -> DataFrame:
    """Segments of the positional index over every row, written to the shared folder (or to the caller's ``store``)."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return (store or Store(df.sparkSession, "phrases")).put(batches_of(df.sparkSession, rows, segment_batches, SEGMENT_DDL), "segments")


@dataclass
class TestSet:
    """A block of test items: its distinct terms, and windows as rows of term numbers (-1 fills short ones)."""

    items: list[str]
    terms: np.ndarray
    windows: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, ids: list[str], texts: list[str | None]) -> TestSet:
        hashes, counts = words_of(pa.array(texts, pa.string()))
        terms, numbers = np.unique(hashes, return_inverse=True)
        rows, owner, at = [np.zeros((0, WINDOW), np.int64)], [np.zeros(0, np.int64)], 0
        for item, n in enumerate(counts):
            own = numbers[at : at + n]
            at += n
            if n >= WINDOW:
                rows.append(np.lib.stride_tricks.sliding_window_view(own, WINDOW))
            elif n:
                rows.append(np.concatenate([own, np.full(WINDOW - n, -1)])[None, :])
            owner.append(np.full(len(rows[-1]) if n else 0, item))
        windows, owners = np.concatenate(rows), np.concatenate(owner)
        return cls(ids, terms, windows, owners)


class Segment:
    def __init__(self, row: dict):
        of = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.number, self.doc_ids, self.null_ids = row["segment"], of("doc_ids", np.int64), of("null_ids", np.bool_)
        self.doc_starts, self.terms, self.term_starts = of("doc_starts", np.int64), of("terms", np.uint64), of("term_starts", np.int64)
        self.postings = of("postings", np.uint32)

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each term's list begins and how long it is (0: the segment lacks the term)."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        size = np.where(self.terms[at] == terms, self.term_starts[at + 1] - self.term_starts[at], 0)
        return self.term_starts[at], size

    def matches(self, tests: TestSet, misses: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Window, start number, length and differing words of every phrase and proximity match."""
        begin, size = self.lists(tests.terms)
        filled = tests.windows >= 0
        lengths = filled.sum(axis=1)
        allowed = np.where(lengths == WINDOW, misses, 0)
        sizes = np.where(filled, size[tests.windows], np.iinfo(np.int64).max) if len(size) else np.zeros(tests.windows.shape, np.int64)
        out: list[tuple] = []
        for w in np.flatnonzero((sizes == 0).sum(axis=1) <= allowed):
            terms, spare = tests.windows[w], int(allowed[w])
            rare_first = np.argsort(sizes[w], kind="stable")[: lengths[w]]
            moved = [self.postings[begin[terms[o]] : begin[terms[o]] + size[terms[o]]].astype(np.int64) - o for o in rare_first[: spare + 1]]
            starts = moved[0] if len(moved) == 1 else np.unique(np.concatenate(moved))
            starts = starts[starts >= 0]
            missed = np.zeros(len(starts), np.int64)
            for o in rare_first:
                low, n = begin[terms[o]], size[terms[o]]
                if n:
                    postings = self.postings[low : low + n]
                    wanted = (starts + o).astype(np.uint32)
                    missed += postings[np.minimum(np.searchsorted(postings, wanted), n - 1)] != wanted
                else:
                    missed += 1
                stay = missed <= spare
                starts, missed = starts[stay], missed[stay]
                if not len(starts):
                    break
            if len(starts):
                # A proximity match may not run over its document's end; an exact one cannot.
                doc = np.searchsorted(self.doc_starts, starts, side="right")
                ok = starts + lengths[w] < self.doc_starts[doc]
                out.append((np.full(ok.sum(), w), starts[ok], np.full(ok.sum(), lengths[w]), missed[ok]))
        return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out, strict=True) if out else [()] * 4))


FOUND = pa.schema([
    ("segment", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.int64())),
    ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string())),
])
FOUND_DDL = "segment long, at long, doc_id long, n_words long, hits array<long>, items array<string>, near array<string>"


def search_batches(tests: TestSet, misses: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                window, start, length, missed = segment.matches(tests, misses)
                n_docs = len(segment.doc_ids)
                exact = missed == 0
                cover = np.zeros(segment.doc_starts[-1] + 1, np.int64)
                np.add.at(cover, start[exact], 1)
                np.add.at(cover, start[exact] + length[exact], -1)
                hit = np.flatnonzero(np.cumsum(cover) > 0)
                hit_doc = np.searchsorted(segment.doc_starts, hit, side="right") - 1
                cuts = np.searchsorted(hit_doc, np.arange(n_docs + 1))
                hits = [hit[cuts[d] : cuts[d + 1]] - segment.doc_starts[d] for d in range(n_docs)]
                names: list[list[set]] = [[set(), set()] for _ in range(n_docs)]
                doc, owner = np.searchsorted(segment.doc_starts, start, side="right") - 1, tests.owner[window]
                for d, item, near in np.unique(np.stack([doc, owner, (~exact).astype(np.int64)], axis=1), axis=0):
                    names[d][near].add(tests.items[item])
                yield record(FOUND, [
                    np.full(n_docs, segment.number), np.arange(n_docs), pa.array(segment.doc_ids, mask=segment.null_ids),
                    np.diff(segment.doc_starts) - 1, hits, [sorted(x[0]) for x in names], [sorted(x[1] - x[0]) for x in names],
                ])

    return run


def search(segments: DataFrame, items: DataFrame, misses: int = 0, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per indexed document: n_words, hits (word positions inside exact matches), items, near (items with proximity matches only)."""
    spark = segments.sparkSession
    named = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    total = named.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = 1 + total // BLOCK_BYTES
    found = None
    for block in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES
        tests = TestSet.of([r.item for r in rows], [r.text for r in rows])
        part = batches_of(spark, segments, search_batches(tests, misses), FOUND_DDL)
        found = part if found is None else found.unionByName(part)
    if blocks == 1:
        return found
    joined = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    merged = found.groupBy("segment", "at", "doc_id", "n_words").agg(joined("hits"), joined("items"), joined("near"))
    return merged.withColumn("near", F.array_except("near", "items"))


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The verdict on each document: contaminated if words are hit, and at least one in twenty."""
    n_hit, n_items = F.size("hits").cast("long"), F.size("items").cast("long")
    return found.select(
        F.col("doc_id").alias(id_col), "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


def contamination(docs: DataFrame, items: DataFrame, misses: int = 2, store: Store | None = None) -> DataFrame:
    return report(search(index(docs, store=store), items, misses))
