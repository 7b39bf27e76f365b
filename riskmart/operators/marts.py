"""Aggregate marts. Decimals are summed exactly and turned into doubles once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product as product_of

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.contracts import SCORE_BANDS, UNKNOWN_LABEL
from riskmart.functions.measures import money
from riskmart.operators.warehouse import workload_slice
from riskmart.sources.tables import broadcast_if_small, hash_side


class MartError(RuntimeError):
    """A mart does not add up to its fact."""


def _with_dims(fact: DataFrame, dims: Mapping[str, DataFrame], **wanted: tuple[str, ...]) -> DataFrame:
    for name, columns in wanted.items():
        dim = dims[name].select(f"{name}_key", *columns)
        fact = fact.join(broadcast_if_small(dim), f"{name}_key")
    return fact


def _totals() -> list[Column]:
    return [money(F.sum("premiums")).alias("premium"), money(F.sum("claims")).alias("claims")]


def monthly(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Premium, claims and rows per month and state."""
    # Grouping on the keys first leaves only the mart to join and sort.
    grouped = fact.groupBy("month_key", "state_key").agg(*_totals(), F.count("*").alias("observations"))
    named = _with_dims(grouped, dims, month=("year_month",), state=("state",))
    return named.select(
        F.col("year_month").cast("string").alias("month"), "state", "premium", "claims", "observations"
    ).orderBy("month", "state")


def by_year(fact: DataFrame, dims: Mapping[str, DataFrame], entity: str) -> DataFrame:
    """Premium and claims per calendar year, state and entity (``company`` or ``product``)."""
    grouped = fact.groupBy("calendar_year", "state_key", f"{entity}_key").agg(*_totals())
    return _with_dims(grouped, dims, state=("state",)).select(
        F.col("calendar_year").alias("year"), "state", F.col(f"{entity}_key").alias(entity), "premium", "claims"
    )


def risk_segments(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Risk totals per state, gender and age. Groups raw values, labels NULL afterwards."""
    grouped = fact.groupBy("driver_key", "geography_key").agg(
        F.count("*").alias("observations"),
        F.sum("expos_total").alias("exposure"),
        F.sum("prem_total").alias("premium"),
        F.sum("total_claim_count").alias("claim_count"),
        F.sum("total_claim_amount").alias("claims"),
        F.sum("has_claim").alias("has_claim"),
    )
    named = _with_dims(grouped, dims, driver=("gender", "driv_age"), geography=("state_ab",))
    return (
        named.groupBy("state_ab", "gender", "driv_age")
        .agg(
            F.sum("observations").alias("observations"),
            money(F.sum("exposure")).alias("exposure"),
            money(F.sum("premium")).alias("premium"),
            F.sum("claim_count").alias("claim_count"),
            money(F.sum("claims")).alias("claims"),
            F.sum("has_claim").alias("has_claim"),
        )
        .select(
            F.coalesce("state_ab", F.lit(UNKNOWN_LABEL)).alias("state"),
            F.coalesce("gender", F.lit(UNKNOWN_LABEL)).alias("gender"),
            F.coalesce("driv_age", F.lit(UNKNOWN_LABEL)).alias("age"),
            "observations",
            "exposure",
            "premium",
            "claim_count",
            "claims",
            "has_claim",
        )
    )


def score_bands(predictions: DataFrame, fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Predictions joined to facts by technical key, banded in steps of 1/20."""
    identity = ["source_file", "source_version", "source_row_number"]
    joined = predictions.select(*identity, "score").join(
        hash_side(fact.select(*identity, "geography_key", "has_claim")), identity
    )
    grouped = joined.groupBy(
        "geography_key", F.floor(F.col("score").cast("double") * SCORE_BANDS).cast("int").alias("band")
    ).agg(
        F.count("*").alias("observations"),
        F.sum("score").alias("score_sum"),
        F.sum("has_claim").alias("positives"),
    )
    named = _with_dims(grouped, dims, geography=("state_ab",))
    return (
        named.groupBy("state_ab", "band")
        .agg(
            F.sum("observations").alias("observations"),
            money(F.sum("score_sum"), 6).alias("score_sum"),
            F.sum("positives").alias("positives"),
        )
        .select(F.coalesce("state_ab", F.lit(UNKNOWN_LABEL)).alias("state"), "band", "observations", "score_sum", "positives")
    )


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row with the row count of every named layer."""
    counts = None
    for name, df in layers.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts.agg(*[F.sum(F.when(F.col("layer") == name, F.col("rows"))).alias(name) for name in layers])


def lookup_names(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Key to display name of companies and products."""
    companies = dims["company"].select(F.lit("company").alias("kind"), F.col("company_key").alias("key"), F.col("company_name").alias("name"))
    products = dims["product"].select(F.lit("product").alias("kind"), F.col("product_key").alias("key"), F.col("product").alias("name"))
    return companies.unionByName(products)


def _member_keys(dim: DataFrame, key: str, condition: Column, limit: int = 1000) -> list[int] | None:
    """Keys of the chosen members, or None when there are too many to list."""
    rows = dim.where(condition).select(key).limit(limit + 1).collect()
    return [r[0] for r in rows] if len(rows) <= limit else None


def _members_of(fact: DataFrame, dim: DataFrame, key: str, condition: Column) -> DataFrame:
    """Fact rows of the chosen members: literal keys reach the Parquet scan."""
    keys = _member_keys(dim, key, condition)
    if keys is not None:
        return fact.where(F.col(key).isin(keys) if keys else F.lit(False))
    return fact.join(dim.where(condition).select(key), key, "left_semi")


def _sliced(fact: DataFrame, workload: str, members: Sequence[list[int] | None]) -> DataFrame:
    """Only the slices of the chosen members, if the fact is a copy laid out for the workload and the members are few."""
    name = f"{workload}_slice"
    if name not in fact.columns or any(m is None for m in members):
        return fact
    slices = [F.col(name) == workload_slice(*[F.lit(k).cast("bigint") for k in keys]) for keys in product_of(*members)]
    return fact.where(reduce(lambda a, b: a | b, slices, F.lit(False)))


def company_by_month(fact: DataFrame, dims: Mapping[str, DataFrame], company_code: int, from_year: int) -> DataFrame:
    """Hot workload 1: one company from a year on, by month."""
    wanted = F.col("company_code") == company_code
    fact = _sliced(fact, "company", [_member_keys(dims["company"], "company_key", wanted)])
    chosen = _members_of(fact, dims["company"], "company_key", wanted)
    grouped = chosen.where(F.col("calendar_year") >= from_year).groupBy("month_key").agg(*_totals())
    return _with_dims(grouped, dims, month=("year_month",)).select(
        F.lit(company_code).alias("company_code"), F.col("year_month").cast("string").alias("month"), "premium", "claims"
    ).orderBy("month")


def state_product_by_month(
    fact: DataFrame, dims: Mapping[str, DataFrame], state: str, product: str, from_year: int
) -> DataFrame:
    """Hot workload 2: one state and product from a year on, by month."""
    named = {"state": F.col("state") == state, "product": F.col("product") == product}
    fact = _sliced(fact, "state_product", [_member_keys(dims[d], f"{d}_key", condition) for d, condition in named.items()])
    chosen = _members_of(fact, dims["state"], "state_key", F.col("state") == state)
    chosen = _members_of(chosen, dims["product"], "product_key", F.col("product") == product)
    grouped = chosen.where(F.col("calendar_year") >= from_year).groupBy("month_key").agg(*_totals())
    return _with_dims(grouped, dims, month=("year_month",)).select(
        F.lit(state).alias("state"),
        F.lit(product).alias("product"),
        F.col("year_month").cast("string").alias("month"),
        "premium",
        "claims",
    ).orderBy("month")


def reconciliation(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Observations of a mart against the rows of its fact."""
    total = mart.agg(F.sum("observations").alias("mart"))
    return layer_counts(fact_rows=fact).select(
        F.lit("observations").alias("measure"), total.scalar().alias("mart_observations"), "fact_rows"
    ).withColumn("status", F.when(F.col("mart_observations") == F.col("fact_rows"), "SUCCESS").otherwise("FAILED"))


def require_reconciled(mart: DataFrame, fact: DataFrame) -> None:
    row = reconciliation(mart, fact).first()
    if row.status != "SUCCESS":
        raise MartError(f"mart observations {row.mart_observations} differ from fact rows {row.fact_rows}")
