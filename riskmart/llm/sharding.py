"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; rank over the source's row count is the fractional rank. Sorted by it, the sources
interleave in proportion, so every cut of the order holds the mixture; cutting at equal row counts gives the shards. A source's ranks are moved by
a fraction of one step, taken from its name: else all sources of one size would stand on the same fractional ranks.

Both ranks are exact and no task holds a source or a shard: hash slices within a source, and slices of the fractional rank, which are even by
construction, are numbered each for itself and moved by a running total over the slices.

Defined cases: a null text counts as none (size 1, crc32 0), null sources are one source, repeated rows are rows of their own, ties in the order are
broken by hash, id, size and crc32 (rows equal in all of these are interchangeable). An empty table gives an empty result. Only id, source and what
is derived from the text are carried, so other columns cannot clash. The law is ``rows``: shard sizes differ by one row at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import Store

LAW = "rows"
SLICE_ROWS = 20_000
LEAST_SLICES, MOST_SLICES = 64, 65_536
HASH_DIGITS = 3


def described(df: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source key, size, crc32 and the seeded shuffle hash of each row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")).alias("source_key"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("h"),
    )


def fractional(rows: DataFrame) -> DataFrame:
    """Adds ``frac``: the shifted rank within the source over the source's rows, in (0, 1)."""
    sliced = rows.withColumn("cut", F.substring("h", 1, HASH_DIGITS))
    counts = sliced.groupBy("source_key", "cut").agg(F.count(F.lit(1)).alias("n"))
    by_source = Window.partitionBy("source_key")
    before = by_source.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_key", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(by_source).alias("total"))
    inside = Window.partitionBy("source_key", "cut").orderBy("h", "doc_id", "size", "text_crc32")
    ranked = sliced.withColumn("at", F.row_number().over(inside)).join(starts, ["source_key", "cut"])
    shift = (F.conv(F.substring(F.md5(F.col("source_key").cast("binary")), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0**32)
    return ranked.select(*rows.columns, (((F.col("start") + F.col("at")).cast("double") - shift) / F.col("total").cast("double")).alias("frac"))


def shards(
    df: DataFrame, count: int = 16, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """id, size, text_crc32, law, shard (0 to count - 1), slot (gapless from 0 in its shard), grown_shard (null under this law)."""
    spark = df.sparkSession
    store = Store(spark, "shards")
    rows = store.put(described(df, seed, id_col, text_col, source_col), "rows")
    total = rows.count()
    slices = min(MOST_SLICES, max(LEAST_SLICES, total // SLICE_ROWS))
    ordered = store.put(fractional(rows).withColumn("cut", F.least(F.floor(F.col("frac") * slices), F.lit(slices - 1)).cast("int")), "ordered")
    counts = ordered.groupBy("cut").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)  # one row for each slice, MOST_SLICES at most
    starts = counts.select("cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("cut").orderBy("frac", "source_key", "h", "doc_id", "size", "text_crc32")
    placed = ordered.withColumn("at", F.row_number().over(inside)).join(F.broadcast(starts), "cut").select(
        "doc_id", "size", "text_crc32", (F.col("start") + F.col("at") - 1).alias("place")
    )
    shard = F.expr(f"place * {count} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {count - 1}) div {count}")
    return placed.withColumn("shard", shard.cast("int")).select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("place") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
