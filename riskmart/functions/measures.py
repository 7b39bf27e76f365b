"""Ratios and derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two totals; NULL where the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def add_up(columns: list[Column]) -> Column:
    total = columns[0]
    for column in columns[1:]:
        total = total + column
    return total


def claim_measures(counts: list[Column], amounts: list[Column], exposure: Column, premium: Column) -> dict[str, Column]:
    """The five measures stored next to each risk observation."""
    count = add_up(counts)
    amount = add_up(amounts)
    return {
        "total_claim_count": count,
        "total_claim_amount": amount,
        "has_claim": (count > 0).cast("int"),
        "claim_frequency": F.when(exposure > 0, count.cast("decimal(38,17)") / exposure),
        "loss_ratio": F.when(premium > 0, amount.cast("decimal(38,6)") / premium),
    }


def money(column: Column, places: int = 4) -> Column:
    """An exact decimal total as a double, rounded once at the end."""
    return F.round(column.cast("double"), places)
