"""What the training-data operators share: scans, stored tables, batch bounds, text hashing."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.sources.tables import delete_folder, shared_folder

BATCH_BYTES = 4 * 1024 * 1024
#: White space of the word rules: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes, so that a Python worker holds a few MB however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Store:
    """Tables written to the shared folder, so that later steps start from files and outlive executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        # The table is read by who wrote it: no marker file, for which the driver starts child processes on a local file system.
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, f"{self.base}/{name}")

    def keep(self, *names: str) -> None:
        """Drops all tables but these."""
        jvm = self.spark.sparkContext._jvm
        base = jvm.org.apache.hadoop.fs.Path(self.base)
        for status in base.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(base):
            if status.getPath().getName() not in names:
                delete_folder(self.spark, status.getPath().toString())

    def clear(self) -> None:
        """Drops all tables; what is still computed from them must have been written before."""
        delete_folder(self.spark, self.base)


#: An anti join broadcasts its ids up to this many, else it shuffles.
BROADCAST_IDS = 500_000


def without(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is not among ``ids`` (a stored table with one column ``gone``); rows without an id stay."""
    gone = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return df.join(gone, df[id_col] == gone["gone"], "left_anti")


def first_in_hash_order(df: DataFrame, limit: int, *ties: str) -> list:
    """The first ``limit`` rows by column ``h`` (a 64-bit hash). Past a few times the limit only the lowest share of the hashes is sorted, so that
    what reaches the driver does not grow with the input."""
    total = df.count()
    if total > 8 * limit:
        low = -(2**63) + int(2**64 * 4 * limit / total)
        rows = df.where(F.col("h") < low).orderBy("h", *ties).limit(limit).collect()
        if len(rows) == limit:
            return rows
    return df.orderBy("h", *ties).limit(limit).collect()


def crc_mod(column: str, divisor: int):
    """crc32 of a number written as text, modulo a divisor."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def text_pieces(batch: pa.RecordBatch, limit: int = BATCH_BYTES, text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of a piece take few MB; a longer text is a piece of its own."""
    texts = batch.column(text_col)
    sizes = np.array([0 if n is None else n for n in pc.binary_length(texts).to_pylist()], dtype=np.int64)
    start, total = 0, 0
    for at, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each text starts (one more entry than texts); null is empty."""
    texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


HASH_BLOCK = 1 << 18
_FORTH, _BACK = _powers(_BASE, HASH_BLOCK + 1), _powers(_INVERSE, HASH_BLOCK + 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans in order; equal bytes have equal hashes wherever they stand.

    A polynomial over 64-bit byte values, taken from running sums over blocks of spans: the cost is that of the bytes, in numpy, and the
    memory that of a block or of the longest span.
    """
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + HASH_BLOCK, side="right")))
        part = data[low : ends[stop - 1]]
        short = len(part) <= HASH_BLOCK
        forth, back = (_FORTH, _BACK) if short else (_powers(_BASE, len(part)), _powers(_INVERSE, 1))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[part] * forth[: len(part)], out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low  # a span longer than a block is alone and starts at 0
        out[at:stop] = (sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64)
        at = stop
    return mixed(out)


def word_spans(data: np.ndarray, starts: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes within one text, and the number of runs by text."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = is_word[data]
    inside = flags[1:-1].astype(bool)
    first = inside & (flags[:-2] == 0)
    last = inside & (flags[2:] == 0)
    cuts = starts[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= inside[cuts]  # a text ends a word
    last[cuts - 1] |= inside[cuts - 1]
    begins = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(begins, starts))
    return begins, np.flatnonzero(last) + 1, counts


def byte_class(*ranges: tuple[int, int], inverted: bool = False) -> np.ndarray:
    """Table of 256 flags for byte ranges, ends included."""
    flags = np.zeros(256, dtype=bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return ~flags if inverted else flags


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 0x41) & (data <= 0x5A)
    return data + (upper * np.uint8(32)).astype(np.uint8)


def give_back() -> None:
    """Unused memory of Arrow and of the C heap goes back to the system; a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def batches_of(spark: SparkSession, df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` under bounded batches; a task that ends gives unused memory back, as its worker lives on."""

    def run(batches):
        yield from function(batches)
        give_back()

    bound_batches(spark)
    return df.mapInArrow(run, schema)


def record(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
