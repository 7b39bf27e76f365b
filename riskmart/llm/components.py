"""Connected components of a graph given as links: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import Store


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.union(least.select("a", F.col("m").alias("b"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Every node has one row at most and no hub has a row of its own."""
    sides = edges.select(F.col("a").alias("x"), F.lit(1).alias("row"), F.lit(0).alias("hub")).union(edges.select("b", F.lit(0), F.lit(1)))
    return sides.groupBy("x").agg(F.sum("row").alias("row"), F.max("hub").alias("hub")).where("row > 1 or row > 0 and hub > 0").isEmpty()


def components(links: DataFrame, store: Store, name: str) -> DataFrame:
    """(a, b): b is the least node of a's component; a node that is the least itself has no row.

    Each round is written and read back; it ends when only stars are left, after a number of rounds that grows with the logarithm of the
    largest component. Minima are taken map-side first, and the join back to them may be split, so a hub of any degree is no hot task.
    """
    edges = store.put(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-0")
    number = 0
    while not _is_stars(edges):
        number += 1
        edges = store.put(_small(_large(edges)), f"{name}-{number}")
        store.drop(f"{name}-{number - 1}")
    return edges
