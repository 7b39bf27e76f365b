"""KPIs, comparisons, rankings and score bands over the marts.

Inputs are marts, so frames here hold months, states or bands, not source rows.
Totals come in as scalar subqueries; nothing is joined to everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.contracts import SCORE_BANDS, UNKNOWN_EXPORT_LABEL, UNKNOWN_LABEL
from riskmart.functions.formatting import company_short_label, product_label, product_short_label
from riskmart.functions.measures import ratio

ALL = "ALL"
PAGE_SIZE = 15
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def with_year(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("year", F.substring("month", 1, 4).cast("int"))


def select_market(frame: DataFrame, state: str | None, years: tuple[int, int]) -> DataFrame:
    """State (``ALL`` keeps every state) and inclusive year range."""
    if "year" not in frame.columns:
        frame = with_year(frame)
    frame = frame.where(F.col("year").between(*years))
    return frame.where(F.col("state") == state) if state and state != ALL else frame


def select_risk(frame: DataFrame, state: str | None) -> DataFrame:
    return frame.where(F.col("state") == state) if state and state != ALL else frame


def market_kpis(monthly: DataFrame) -> DataFrame:
    """Totals and ratio of totals of a selection."""
    return monthly.agg(
        F.coalesce(F.sum("premium"), F.lit(0.0)).alias("premium"),
        F.coalesce(F.sum("claims"), F.lit(0.0)).alias("claims"),
        F.coalesce(F.sum("observations"), F.lit(0)).alias("observations"),
    ).withColumn("claim_ratio", ratio(F.col("claims"), F.col("premium")))


def trend(monthly: DataFrame, annual: bool = False) -> DataFrame:
    period = F.substring("month", 1, 4) if annual else F.col("month")
    return (
        monthly.groupBy(period.alias("period"))
        .agg(F.sum("premium").alias("premium"), F.sum("claims").alias("claims"))
        .orderBy("period")
    )


def _month_name(number: Column) -> Column:
    return F.substring(F.lit(MONTHS), number * 3 - 2, F.lit(3))


def range_comparison(selected: DataFrame, monthly: DataFrame, state: str | None, years: tuple[int, int]) -> DataFrame:
    """End year against start year (or the year before) over the same months.

    One row, or none when the end year is empty, a baseline month is missing or
    a premium total is not positive. A change whose baseline is not positive is NULL.
    """
    first, latest = years
    baseline_year = first if first < latest else latest - 1
    if "year" not in selected.columns:
        selected = with_year(selected)
    before = selected if first < latest else select_risk(with_year(monthly), state)
    measures = ("premium", "claims", "observations")

    def by_month(frame: DataFrame, year: int, prefix: str) -> DataFrame:
        rows = frame.where(F.col("year") == year)
        return rows.groupBy(F.substring("month", 6, 2).cast("int").alias("calendar_month")).agg(
            *[F.sum(m).alias(f"{prefix}_{m}") for m in measures]
        )

    matched = by_month(selected, latest, "now").join(by_month(before, baseline_year, "old"), "calendar_month", "left")
    totals = matched.agg(
        *[F.sum(f"{side}_{m}").alias(f"{side}_{m}") for side in ("now", "old") for m in measures],
        F.count("*").alias("months"),
        F.count_if(F.col("old_premium").isNull()).alias("gaps"),
        F.min("calendar_month").alias("low"),
        F.max("calendar_month").alias("high"),
    ).where("months > 0 AND gaps = 0 AND now_premium > 0 AND old_premium > 0")
    low, high = _month_name(F.col("low")), _month_name(F.col("high"))
    span = F.when(F.col("months") == 1, low).otherwise(F.concat(low, F.lit("–"), high))
    label = F.when(
        F.col("months") == F.col("high") - F.col("low") + 1,
        F.concat(span, F.lit(f" {latest} vs "), span, F.lit(f" {baseline_year}")),
    ).otherwise(F.concat(F.lit(f"{latest} vs {baseline_year} · "), F.col("months").cast("string"), F.lit(" matched months")))

    def change(measure: str) -> Column:
        old = F.col(f"old_{measure}")
        return F.when(old > 0, 100 * (F.col(f"now_{measure}") / old - 1))

    def claim_ratio(side: str) -> Column:
        return F.col(f"{side}_claims") / F.col(f"{side}_premium")

    return totals.select(
        label.alias("period"),
        change("premium").alias("premium_change"),
        (100 * (claim_ratio("now") - claim_ratio("old"))).alias("ratio_change_pp"),
        change("claims").alias("claims_change"),
        change("observations").alias("observations_change"),
    )


def top_entities(frame: DataFrame, entity: str, limit: int) -> DataFrame:
    """Largest entities by premium with their share of all selected premium."""
    total = frame.agg(F.sum("premium").alias("total"))
    ranked = frame.groupBy(entity).agg(F.sum("premium").alias("premium")).orderBy(F.desc("premium"), entity).limit(limit)
    return ranked.select(entity, "premium", (100 * ratio(F.col("premium"), total.scalar())).alias("share"))


def with_labels(ranked: DataFrame, lookup: DataFrame, entity: str) -> DataFrame:
    """Adds the display label and its short form; a missing name falls back to the key."""
    names = lookup.where(F.col("kind") == entity).select(F.col("key").alias(entity), "name")
    named = ranked.join(names, entity, "left")
    source = F.coalesce("name", F.col(entity).cast("string"))
    if entity == "company":
        label, short = source, company_short_label
    else:
        label, short = product_label(source), product_short_label
    return named.withColumn("label", label).withColumn("short_label", short(F.col("label"))).drop("name")


def concentration(frame: DataFrame, entity: str, limit: int) -> DataFrame:
    """Premium share of the top entities."""
    top = top_entities(frame, entity, limit).agg(F.sum("premium").alias("top_premium"))
    total = frame.agg(F.sum("premium").alias("total"))
    return top.select(
        F.lit(entity).alias("entity"), "top_premium", ratio(F.col("top_premium"), total.scalar()).alias("share")
    )


def risk_kpis(segments: DataFrame, bands: DataFrame) -> DataFrame:
    scored = bands.agg(F.sum("observations").alias("n"), F.sum("score_sum").alias("s"))
    return segments.agg(
        F.sum("observations").alias("observations"),
        F.sum("exposure").alias("exposure"),
        F.sum("claim_count").alias("claim_count"),
    ).select(
        "observations",
        "exposure",
        ratio(F.col("claim_count"), F.col("exposure")).alias("claims_per_exposure"),
        scored.select("n").scalar().alias("scored"),
        scored.select(ratio(F.col("s"), F.col("n"))).scalar().alias("mean_score"),
    )


def score_histogram(bands: DataFrame) -> DataFrame:
    """All bands in order; a score of 1 falls in the last, empty bands count zero."""
    summed = bands.groupBy(F.least("band", F.lit(SCORE_BANDS - 1)).alias("band")).agg(
        F.sum("observations").alias("observations"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("positives").alias("positives"),
    )
    every = bands.sparkSession.range(SCORE_BANDS).select(F.col("id").cast("int").alias("band"))
    return every.join(summed, "band", "left").fillna(0, ["observations", "score_sum", "positives"]).orderBy("band")


def score_calibration(bands: DataFrame) -> DataFrame:
    """Observed claim share against mean score per band; NULL for an empty band."""
    size = F.col("observations")
    return score_histogram(bands).select(
        "band",
        ((F.col("band") + 0.5) / SCORE_BANDS).alias("center"),
        "observations",
        (100 * ratio(F.col("positives"), size)).alias("observed_share"),
        (100 * ratio(F.col("score_sum"), size)).alias("mean_score"),
    )


def score_groups(bands: DataFrame) -> DataFrame:
    """Low (below 0.20) and high (0.50 and up) score groups."""
    low, high = F.col("band") < 4, F.col("band") >= 10

    def total(column: str, group: Column) -> Column:
        return F.coalesce(F.sum(F.when(group, F.col(column))), F.lit(0))

    sums = score_histogram(bands).agg(
        F.sum("observations").alias("population"),
        total("observations", low).alias("low_observations"),
        total("positives", low).alias("low_positives"),
        total("observations", high).alias("high_observations"),
        total("positives", high).alias("high_positives"),
    )
    return sums.select(
        "population",
        "low_observations",
        ratio(F.col("low_observations"), F.col("population")).alias("low_share"),
        ratio(F.col("low_positives"), F.col("low_observations")).alias("low_claim_share"),
        "high_observations",
        ratio(F.col("high_positives"), F.col("high_observations")).alias("high_claim_share"),
    )


def export_label(column: str) -> Column:
    return F.when(F.col(column) == UNKNOWN_LABEL, UNKNOWN_EXPORT_LABEL).otherwise(F.col(column))


def age_share(segments: DataFrame, order: Sequence[str]) -> DataFrame:
    """Claim share per age group in the given order; absent groups drop out."""
    overall = segments.select((100 * ratio(F.sum("has_claim"), F.sum("observations"))).alias("overall"))
    rank = F.coalesce(*[F.when(F.col("age") == label, F.lit(at)) for at, label in enumerate(order)])
    return (
        segments.groupBy(export_label("age").alias("age"))
        .agg(F.sum("observations").alias("observations"), F.sum("has_claim").alias("has_claim"))
        .withColumn("position", rank)
        .where(F.col("position").isNotNull())
        .select(
            "position",
            "age",
            "observations",
            "has_claim",
            (100 * ratio(F.col("has_claim"), F.col("observations"))).alias("share"),
            overall.scalar().alias("overall_share"),
        )
        .orderBy("position")
    )


def gender_mix(segments: DataFrame) -> DataFrame:
    total = segments.agg(F.sum("observations").alias("total"))
    return (
        segments.groupBy(export_label("gender").alias("gender"))
        .agg(F.sum("observations").alias("observations"))
        .select("gender", "observations", (100 * ratio(F.col("observations"), total.scalar())).alias("share"))
        .orderBy("observations", "gender")
    )


EXPLORER_ORDER = {
    "market": [("month", False), ("state", True)],
    "risk": [("observations", False), ("state", True), ("gender", True), ("age", True)],
}


def explorer_page(frame: DataFrame, track: str, state: str = ALL, page: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """One page of mart rows; the page number is held to the valid range.

    Sort, offset and limit run as one top-k, so no task sorts the whole mart.
    """
    frame = select_risk(frame, state)
    if track == "risk":
        frame = frame.withColumns({c: export_label(c) for c in ("state", "gender", "age")})
        share = ratio(F.col("has_claim"), F.col("observations"))
    else:
        share = ratio(F.col("claims"), F.col("premium"))
    pages = max(1, -(-frame.count() // size))
    page = max(0, min(int(page or 0), pages - 1))
    order = [F.col(c).asc() if up else F.col(c).desc() for c, up in EXPLORER_ORDER[track]]
    return frame.withColumn("share", share).orderBy(*order).offset(page * size).limit(size)


def platform_kpis(counts: DataFrame, workloads: DataFrame) -> DataFrame:
    """Observations, matched tracks and read reduction per workload."""
    matched = (F.col("market_staging") == F.col("market_fact")).cast("int") + (
        F.col("risk_staging") == F.col("risk_fact")
    ).cast("int")
    summary = counts.select((F.col("market_fact") + F.col("risk_fact")).alias("n"), matched.alias("m"))
    return workloads.select(
        "workload",
        (100 * (1 - F.col("after_reads") / F.col("before_reads"))).alias("read_reduction"),
        summary.select("n").scalar().alias("observations"),
        summary.select("m").scalar().alias("tracks_matched"),
    )


def export_segments(segments: DataFrame) -> DataFrame:
    """Risk segments as exported: the unknown label is spelled out in English."""
    return segments.withColumns({c: export_label(c) for c in ("state", "gender", "age")})
