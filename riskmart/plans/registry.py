"""Registry of queries: a Spark plan and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmart.plans.fixtures import Sources, sources
from riskmart.plans.oracle import with_sources

Plan = Callable[[Sources], DataFrame]
PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            ORACLES[name] = with_sources(sql)
        return plan

    return add


def runnable(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plan(sources(spark, folder))

    return run
