"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmart.plans import (  # noqa: F401  (each module registers its queries)
    analytics_queries,
    contract_queries,
    load_queries,
    ml_queries,
    profile_queries,
    quality_queries,
    stream_queries,
    warehouse_queries,
)
from riskmart.plans.registry import ORACLES, PLANS, runnable


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runnable(plan) for name, plan in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
