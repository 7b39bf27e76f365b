"""Logistic regression on categories by averaged stochastic gradient descent, in rounds over partitions.

A row is the list of the numbers of its categories. In each round every partition starts from the same weights, takes its rows in batches in a seeded
order of its own and returns the mean of the weights it went through; Spark adds these up by weight number, by rows of the partition, and the
mean is where the next round starts. What moves is one number for each category and partition; no task needs more than its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.sources.tables import broadcast_if_small, work_folder, write_table

ALPHA, ROUNDS, BATCH, SEED = 1e-4, 8, 4, 20260923
#: Step size at the start; it falls as 1 / (alpha * rows seen).
FIRST_STEP = 0.5
#: Categories of all features together; their weights are held by every task.
MOST_WEIGHTS = 1_000_000


class TooManyCategoriesError(ValueError):
    """The weights would not fit a task."""


def categories(rows: DataFrame, features: Sequence[str]) -> list[tuple[str, str | None]]:
    """All (feature, value) pairs in order, null included where it occurs; at most ``MOST_WEIGHTS``."""
    pairs = ", ".join(f"'{c}', cast({c} AS string)" for c in features)
    found = rows.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, value)").distinct().limit(MOST_WEIGHTS + 1).collect()
    if len(found) > MOST_WEIGHTS:
        raise TooManyCategoriesError(f"more than {MOST_WEIGHTS} categories")
    return sorted(((r.feature, r.value) for r in found), key=lambda p: (p[0], p[1] is not None, p[1] or ""))


def _joined(rows: DataFrame, table: DataFrame, features: Sequence[str], column: str) -> tuple[DataFrame, list[Column]]:
    """``column`` of ``table`` (feature, value, ...) for each feature of each row; null for a value that the table lacks."""
    found = []
    for at, feature in enumerate(features):
        side = broadcast_if_small(table.where(F.col("feature") == feature).select(F.col("value").alias(f"_v{at}"), F.col(column).alias(f"_x{at}")))
        rows = rows.join(side, rows[feature].cast("string").eqNullSafe(F.col(f"_v{at}")), "left").drop(f"_v{at}")
        found.append(F.col(f"_x{at}"))
    return rows, found


def _round(weights: np.ndarray, intercept: float, number: int, alpha: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        ids, labels = [], []
        for batch in batches:
            column = batch.column("ids")
            ids.append(column.flatten().to_numpy().reshape(len(column), -1))
            labels.append(batch.column("label").to_numpy())
        if not ids:
            return
        x, y = np.concatenate(ids), np.concatenate(labels).astype(np.float64)
        n, w, b = len(y), weights.copy(), intercept
        total, total_b, steps = np.zeros_like(w), 0.0, 0
        order = np.random.default_rng((SEED, number, part)).permutation(n)
        seen = number * n
        for at in range(0, n, BATCH):
            pick = order[at : at + BATCH]
            rate = 1.0 / (alpha * (1.0 / (alpha * FIRST_STEP) + seen + at))
            z = np.clip(w[x[pick]].sum(axis=1) + b, -50, 50)
            g = (1 / (1 + np.exp(-z)) - y[pick]) * (rate / len(pick))
            w *= 1 - rate * alpha
            np.subtract.at(w, x[pick].ravel(), np.repeat(g, x.shape[1]))
            b -= g.sum()
            total += w
            total_b += b
            steps += 1
        # The intercept is number -1; every value is weighted by the partition's rows.
        values = np.append(total, total_b) / steps * n
        numbers = np.append(np.arange(len(w)), -1)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(values), pa.array(np.full(len(values), n))], ["number", "value", "rows"])

    return run


def fit(rows: DataFrame, label: str, features: Sequence[str], partitions: int = 8, rounds: int = ROUNDS, alpha: float = ALPHA) -> DataFrame:
    """Weights as feature, value, weight; the intercept has no feature. ``rows`` is shuffled once, then read in every round."""
    spark = rows.sparkSession
    known = categories(rows, features)
    table = spark.createDataFrame([(f, v, i) for i, (f, v) in enumerate(known)], "feature string, value string, number int")
    with work_folder(spark, "sgd") as folder:
        table = write_table(table.coalesce(1), f"{folder}/categories")
        numbered, found = _joined(rows, table, features, "number")
        encoded = numbered.select(F.array(*found).alias("ids"), F.col(label).cast("int").alias("label"))
        # Dealt out in turn from sorted rows: every partition gets its share of equal rows, whatever is run again.
        encoded = write_table(encoded.repartition(partitions).sortWithinPartitions("label", "ids"), f"{folder}/encoded")
        weights, intercept = np.zeros(len(known)), 0.0
        for number in range(rounds):
            parts = encoded.mapInArrow(_round(weights, intercept, number, alpha), "number int, value double, rows bigint")
            summed = parts.groupBy("number").agg((F.sum("value") / F.sum("rows")).alias("value")).collect()  # MOST_WEIGHTS + 1 at most
            for r in summed:
                if r.number < 0:
                    intercept = r.value
                else:
                    weights[r.number] = r.value
    out = [(f, v, float(w)) for (f, v), w in zip(known, weights, strict=True)] + [(None, None, float(intercept))]
    return spark.createDataFrame(out, "feature string, value string, weight double")


def with_probability(rows: DataFrame, weights: DataFrame, features: Sequence[str], name: str = "probability") -> DataFrame:
    """Adds the probability of label 1; a category without a weight adds nothing."""
    intercept = weights.where("feature is null").agg(F.max("weight").alias("w"))
    joined, found = _joined(rows, weights, features, "weight")
    z = intercept.scalar()
    for value in found:
        z = z + F.coalesce(value, F.lit(0.0))
    return joined.withColumn(name, 1 / (1 + F.exp(-z))).drop(*[f"_x{at}" for at in range(len(features))])
