"""Dimensions, facts and the star view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.functions.hashing import ZERO_HASH, natural_hash
from riskmart.functions.measures import claim_measures
from riskmart.operators.ranks import hash_rank
from riskmart.sources.tables import broadcast_if_small

DRIVER = ("Driver", ("gender", "driv_age"))
VEHICLE = ("Vehicle", ("veh_year", "veh_model", "veh_group"))
GEOGRAPHY = ("Geography", ("area", "state", "state_ab"))

# How the reserved members spell a missing attribute.
UNKNOWN_DRIVER = "Unknown / missing"
UNKNOWN_OTHER = "Unknown / not supplied"


class DimensionError(ValueError):
    """Staging breaks an assumption the dimensions need."""


def members(staging: DataFrame, kind: str, attributes: Sequence[str]) -> DataFrame:
    """Distinct attribute tuples with their null-safe natural hash."""
    return staging.select(*attributes).distinct().select(
        natural_hash(kind, [F.col(c) for c in attributes]).alias("natural_hash"), *attributes
    )


def new_members(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Members whose natural hash is not in the dimension yet."""
    return candidates.join(existing.select("natural_hash"), "natural_hash", "left_anti")


def assign_keys(added: DataFrame, key: str, last_key: int = 0) -> DataFrame:
    """Surrogate keys after ``last_key``, dense and in natural-hash order."""
    ranked = hash_rank(added, "natural_hash", name=key)
    return ranked.select(
        (F.col(key) + F.lit(last_key)).cast("bigint").alias(key), *[c for c in added.columns]
    )


def extend_dimension(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The dimension plus keyed new members. Existing keys never change."""
    last = existing.agg(F.max(key)).first()[0] or 0
    added = assign_keys(new_members(candidates, existing), key, last)
    return existing.unionByName(added.select(*existing.columns))


def unknown_member(dimension: DataFrame, key: str, labels: Mapping[str, str | None]) -> DataFrame:
    """The reserved member: key 0, zero hash."""
    row = dimension.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias(key),
        F.lit(ZERO_HASH).alias("natural_hash"),
        *[F.lit(labels.get(c)).cast(dimension.schema[c].dataType).alias(c)
          for c in dimension.columns if c not in (key, "natural_hash")],
    )
    return dimension.unionByName(row)


def risk_dimension(staging: DataFrame, which: tuple[str, tuple[str, ...]]) -> DataFrame:
    """A keyed risk dimension with its reserved unknown member."""
    kind, attributes = which
    key = f"{kind.lower()}_key"
    keyed = assign_keys(members(staging, kind, attributes), key)
    labels: dict[str, str | None] = {c: UNKNOWN_DRIVER if kind == "Driver" else UNKNOWN_OTHER for c in attributes}
    labels.update({"veh_year": None, "state_ab": None})
    return unknown_member(keyed, key, labels)


def name_conflicts(staging: DataFrame, code: str = "company_code", name: str = "company_name") -> DataFrame:
    """Every (code, name) of a code that has more than one name."""
    pairs = staging.select(code, name).where(F.col(name).isNotNull()).distinct()
    clashing = pairs.groupBy(code).agg(F.count("*").alias("names")).where("names > 1")
    return pairs.join(clashing, code).select(code, name, "names")


def require_one_name(staging: DataFrame, code: str = "company_code", name: str = "company_name") -> None:
    clash = staging.groupBy(code).agg(F.min(name).alias("a"), F.max(name).alias("b")).where("a <> b").limit(1).collect()
    if clash:
        raise DimensionError(f"{code} {clash[0][0]} has several names, e.g. {clash[0].a!r} and {clash[0].b!r}")


def market_members(staging: DataFrame) -> dict[str, DataFrame]:
    """Unkeyed members of the four market dimensions."""
    month = staging.select("year_month").distinct()
    company = staging.groupBy("company_code").agg(F.min("company_name").alias("company_name"))
    product = staging.select("product").distinct()
    state = staging.select("state").distinct()

    def hashed(df: DataFrame, kind: str, column: str) -> DataFrame:
        return df.select(natural_hash(kind, [F.col(column)]).alias("natural_hash"), "*")

    return {
        "month": hashed(
            month.select(
                "year_month", F.year("year_month").alias("calendar_year"), F.month("year_month").alias("calendar_month")
            ),
            "Month",
            "year_month",
        ),
        "company": hashed(company, "Company", "company_code"),
        "product": hashed(product, "Product", "product"),
        "state": hashed(state, "State", "state"),
    }


def market_dimensions(staging: DataFrame) -> dict[str, DataFrame]:
    return {name: assign_keys(df, f"{name}_key") for name, df in market_members(staging).items()}


MARKET_LINEAGE = ("batch_id", "source_file", "source_version", "source_row_number", "record_hash", "loaded_at")
MARKET_KEYS = {"month": "year_month", "company": "company_code", "product": "product", "state": "state"}


def fact_market(staging: DataFrame, dims: Mapping[str, DataFrame], batches: DataFrame) -> DataFrame:
    """One fact per staged row of a SUCCESS batch, with its lineage and its four dimension keys."""
    done = batches.where(F.col("status") == "SUCCESS").select("batch_id")
    fact = staging.join(broadcast_if_small(done), "batch_id", "left_semi")
    for name, natural in MARKET_KEYS.items():
        keys = dims[name].select(natural, f"{name}_key")
        fact = fact.join(broadcast_if_small(keys), natural)
    return fact.select(
        *[c for c in MARKET_LINEAGE if c in staging.columns],
        *[f"{name}_key" for name in MARKET_KEYS],
        "premiums",
        "claims",
        "claim_premium_ratio",
        F.year("year_month").alias("calendar_year"),
    )


WORKLOAD_SLICES = 64
WORKLOADS = {"company": ("company_key",), "state_product": ("state_key", "product_key")}


def workload_slice(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(WORKLOAD_SLICES)).cast("int")


def workload_layout(fact: DataFrame, workload: str) -> DataFrame:
    """The columns one hot workload reads, with the slice its copy is partitioned by: literal keys give a literal slice, so one in
    ``WORKLOAD_SLICES`` partitions is opened."""
    keys = WORKLOADS[workload]
    return fact.select(workload_slice(*[F.col(k) for k in keys]).alias(f"{workload}_slice"), *keys, "calendar_year", "month_key", "premiums", "claims")


def fact_risk(staging: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Null-safe star join of risk staging; the reserved members never match."""
    fact = staging
    for kind, attributes in (DRIVER, VEHICLE, GEOGRAPHY):
        key = f"{kind.lower()}_key"
        dim = dims[kind.lower()].where(F.col(key) != 0).select(
            key, *[F.col(c).alias(f"_{c}") for c in attributes]
        )
        condition = F.lit(True)
        for c in attributes:
            condition = condition & fact[c].eqNullSafe(F.col(f"_{c}"))
        fact = fact.join(broadcast_if_small(dim), condition).drop(*[f"_{c}" for c in attributes])
    described = {c for _, attributes in (DRIVER, VEHICLE, GEOGRAPHY) for c in attributes}
    return with_claim_measures(fact.drop(*described))


def described_risk(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Risk facts with the attributes of their three dimensions."""
    for name, dim in dims.items():
        fact = fact.join(broadcast_if_small(dim.drop("natural_hash")), f"{name}_key")
    return fact


def with_claim_measures(staging: DataFrame) -> DataFrame:
    """Adds the derived claim measures of the risk fact."""
    derived = claim_measures(
        [F.col(c) for c in risk_count_columns(staging)],
        [F.col(c) for c in risk_amount_columns(staging)],
        F.col("expos_total"),
        F.col("prem_total"),
    )
    return staging.withColumns(derived)


def risk_count_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("claim_nb_")]


def risk_amount_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("claim_amount_")]


def missing_facts(candidates: DataFrame, fact: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Candidate rows not in the fact yet: a second load adds nothing."""
    return candidates.join(fact.select(*identity), list(identity), "left_anti")


def market_view(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Readable star view with the per-row ratio (NULL at zero premium)."""
    view = fact.drop("calendar_year")
    for name in MARKET_KEYS:
        view = view.join(broadcast_if_small(dims[name].drop("natural_hash")), f"{name}_key")
    return view.select(
        "year_month",
        "calendar_year",
        "calendar_month",
        "company_code",
        "company_name",
        "product",
        "state",
        "premiums",
        "claims",
        F.col("claim_premium_ratio").alias("source_claim_premium_ratio"),
        F.when(F.col("premiums") != 0, F.col("claims").cast("double") / F.col("premiums").cast("double")).alias(
            "row_claim_premium_ratio"
        ),
        "source_file",
        "source_row_number",
    )


RISK_STAGING_TO_SNAKE = {
    "Gender": "gender", "DrivAge": "driv_age", "VehYear": "veh_year", "VehModel": "veh_model",
    "VehGroup": "veh_group", "Area": "area", "State": "state", "StateAb": "state_ab",
    "ExposTotal": "expos_total", "ExposFireRob": "expos_fire_rob", "PremTotal": "prem_total",
    "PremFireRob": "prem_fire_rob", "SumInsAvg": "sum_ins_avg",
    **{f"ClaimNb{k}": f"claim_nb_{k.lower()}" for k in C.CLAIM_CATEGORIES},
    **{f"ClaimAmount{k}": f"claim_amount_{k.lower()}" for k in C.CLAIM_CATEGORIES},
}
