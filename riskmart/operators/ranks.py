"""Exact ranks and running totals without an unpartitioned window.

Both operators cut the order into slices, count each slice, and number rows
inside their slice only. The result equals one global window, but no task ever
holds more than one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.functions.hashing import packed, unpacked
from riskmart.sources.tables import broadcast_if_small, new_folder, write_table

HASH_DIGITS = 3
SLICE = "_slice"


def hash_rank(
    df: DataFrame,
    hash_col: str,
    groups: Sequence[str] = (),
    ties: Sequence[str] = (),
    name: str = "hash_rank",
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """``row_number()`` per group in hash order.

    The leading hex digits slice the order evenly, because hashes are uniform.
    """
    sliced = df.withColumn("_slice", F.substring(F.col(hash_col), 1, digits))
    counts = sliced.groupBy(*groups, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, "_slice").orderBy(hash_col, *ties)
    numbered = sliced.withColumn("_at", F.row_number().over(inside))
    return numbered.join(starts, [*groups, "_slice"]).select(
        *df.columns, (F.col("_start") + F.col("_at")).alias(name)
    )


def derived_hash_rank(
    df: DataFrame,
    order: Column,
    groups: Sequence[str] = (),
    ties: Sequence[str] = (),
    name: str = "hash_rank",
    digits: int = HASH_DIGITS,
    as_bytes: Sequence[str] = (),
) -> DataFrame:
    """``hash_rank`` in the order of a hash that is derived from the row.

    Rows are dealt by slice in one shuffle. The hash does not move, it is derived
    again behind the shuffle; ``as_bytes`` names text columns that move as bytes.
    The slice stays in column ``SLICE``: what is grouped by it too needs no other
    shuffle. Slice starts are written and read back for the checked broadcast.
    """
    sliced = df.withColumn(SLICE, F.substring(order, 1, digits))
    counts = sliced.groupBy(*groups, SLICE).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts = write_table(starts, new_folder(df.sparkSession, "slice-starts"))
    dealt = sliced.withColumns({c: packed(F.col(c)) for c in as_bytes}).repartition(SLICE)
    inside = Window.partitionBy(*groups, SLICE).orderBy("_order", *ties)
    whole = dealt.withColumns({c: unpacked(F.col(c)) for c in as_bytes}).withColumn("_order", order)
    numbered = whole.withColumn("_at", F.row_number().over(inside))
    return numbered.join(broadcast_if_small(starts), [*groups, SLICE]).select(
        *df.columns, SLICE, (F.col("_start") + F.col("_at")).alias(name)
    )


def running_totals(
    df: DataFrame,
    order: str,
    slice_of: Column,
    sums: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Adds ``cum_<column>``: totals up to and including the row, in order.

    ``df`` holds one row per (group, order value), so a hot value is already one
    row. ``slice_of`` must not decrease as ``order`` grows.
    """

    def direction(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    sliced = df.withColumn("_slice", slice_of)
    totals = sliced.groupBy(*groups, "_slice").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(*groups).orderBy(direction("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *groups, "_slice", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_s_{c}") for c in sums]
    )
    inside = (
        Window.partitionBy(*groups, "_slice")
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inner = sliced.select("*", *[F.sum(c).over(inside).alias(f"_i_{c}") for c in sums])
    return inner.join(starts, [*groups, "_slice"]).select(
        *df.columns, *[(F.col(f"_s_{c}") + F.col(f"_i_{c}")).alias(f"cum_{c}") for c in sums]
    )


def slice_by_bounds(value: Column, bounds: Sequence[float]) -> Column:
    """Index of the slice a value falls in: a balanced tree of comparisons."""
    cuts = sorted(set(bounds))

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(cuts[middle]), pick(low, middle)).otherwise(pick(middle + 1, high))

    return pick(0, len(cuts))
