"""Quality rules as data: each yields (rule, domain, severity, observed, expected, detail).

Row-level rules of one table share a single scan; only rules about keys or
several tables shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.sources.tables import broadcast_if_small

HARD, WARNING = "HARD", "WARNING"
IDENTITY = ("source_file", "source_version", "source_row_number")


class QualityGateError(RuntimeError):
    """At least one hard rule failed."""


@dataclass(frozen=True)
class Check:
    """What a rule is called and what it expects; ``expected`` None means any value."""

    name: str
    domain: str
    detail: str
    severity: str = HARD
    expected: int | None = 0


def observed_rows(one_row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Turns a one-row frame of counts, one column per rule, into rule rows."""
    rows = [
        F.struct(
            F.lit(c.name).alias("rule_name"),
            F.lit(c.domain).alias("domain"),
            F.lit(c.severity).alias("severity"),
            F.col(c.name).cast("bigint").alias("observed"),
            F.lit(c.expected).cast("bigint").alias("expected"),
            F.lit(c.detail).alias("detail"),
        )
        for c in checks
    ]
    return one_row.select(F.inline(F.array(*rows)))


def fused_scan(df: DataFrame, rules: Mapping[Check, str]) -> DataFrame:
    """All row-level rules of a table in one aggregate.

    A rule is the SQL condition of a broken row; its broken rows are counted.
    """
    counts = df.agg(*[F.count_if(F.expr(broken)).alias(check.name) for check, broken in rules.items()])
    return observed_rows(counts, list(rules))


def _single(df: DataFrame, check: Check, value: Column) -> DataFrame:
    return observed_rows(df.agg(value.alias(check.name)), [check])


def duplicates(df: DataFrame, keys: Sequence[str], check: Check, mode: str = "groups") -> DataFrame:
    """Duplicate key groups, or with ``mode='rows'`` the rows in excess of one per key."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    value = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)) if mode == "rows" else F.count("*")
    return _single(repeated, check, value)


def several_values(df: DataFrame, key: str, value: str, check: Check) -> DataFrame:
    """Keys that map to more than one value."""
    spread = df.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high")).where("low <> high")
    return _single(spread, check, F.count("*"))


def one_to_one(df: DataFrame, left: str, right: str, check: Check) -> DataFrame:
    """Violators of a one-to-one mapping, counted from both sides."""
    pairs = df.select(left, right).distinct()

    def clashes(key: str, value: str) -> DataFrame:
        return (
            pairs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(value).alias("n")).where("n > 1")
            .select(F.col(key).alias("violator"))
        )

    return _single(clashes(left, right).unionAll(clashes(right, left)), check, F.count("*"))


def partition_reconciliation(manifest: DataFrame, rows: DataFrame, check: Check) -> DataFrame:
    """Manifest files whose row count differs; a missing file counts zero rows."""
    counts = rows.groupBy("source_file").agg(F.count("*").alias("rows"))
    joined = manifest.join(counts, "source_file", "left")
    return _single(
        joined, check, F.count_if(F.coalesce("rows", F.lit(0)) != F.col("expected_source_rows"))
    )


def batch_reconciliation(batches: DataFrame, staged: DataFrame, rejected: DataFrame, check: Check) -> DataFrame:
    """SUCCESS batches that break expected = accepted + rejected = physical rows."""
    stored = staged.groupBy("batch_id").agg(F.count("*").alias("stored"))
    refused = rejected.groupBy("batch_id").agg(F.count("*").alias("refused"))
    joined = batches.where("status = 'SUCCESS'").join(stored, "batch_id", "left").join(refused, "batch_id", "left")
    broken = (
        (F.col("expected_source_rows") != F.col("accepted_rows") + F.col("rejected_rows"))
        | (F.col("accepted_rows") != F.coalesce("stored", F.lit(0)))
        | (F.col("rejected_rows") != F.coalesce("refused", F.lit(0)))
    )
    return _single(joined, check, F.count_if(broken))


def count_difference(left: DataFrame, right: DataFrame, check: Check) -> DataFrame:
    signed = left.select(F.lit(1).alias("n")).unionAll(right.select(F.lit(-1).alias("n")))
    return _single(signed, check, F.abs(F.coalesce(F.sum("n"), F.lit(0))))


def orphans(fact: DataFrame, dims: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """Facts with a key that no dimension member carries."""
    seen = fact.select(*[f"{name}_key" for name in dims])
    for name, dim in dims.items():
        key = f"{name}_key"
        known = dim.select(key, F.lit(True).alias(f"_{name}"))
        seen = seen.join(broadcast_if_small(known), key, "left")
    lost = reduce(lambda a, b: a | b, [F.col(f"_{name}").isNull() for name in dims])
    return _single(seen, check, F.count_if(lost))


def compared_layers(
    staging: DataFrame, fact: DataFrame, compared: Sequence[str], identity: Check, counts: Check, grain: Check, lineage: Check, mode: str
) -> DataFrame:
    """Four rules on staging and fact from one pass by identity: duplicates of either, count difference, and lineage.

    Lineage counts the fact identities that staging lacks or holds with other
    values in ``compared`` (NULL equals NULL); values are compared as two 64-bit
    hashes. ``mode`` is that of ``duplicates``.
    """
    seal = (F.xxhash64(*compared).alias("h"), F.xxhash64(F.lit(7), *reversed(compared)).alias("g"))
    sides = staging.select(*IDENTITY, F.lit(1).alias("s"), F.lit(0).alias("f"), *seal).unionAll(
        fact.select(*IDENTITY, F.lit(0).alias("s"), F.lit(1).alias("f"), *seal)
    )
    by_identity = sides.groupBy(*IDENTITY).agg(
        F.sum("s").alias("s"), F.sum("f").alias("f"), F.min("h").alias("h"), F.max("h").alias("h_top"), F.min("g").alias("g"), F.max("g").alias("g_top")
    )

    def repeated(side: str) -> Column:
        return F.coalesce(F.sum(F.greatest(F.col(side) - 1, F.lit(0))), F.lit(0)) if mode == "rows" else F.count_if(F.col(side) > 1)

    differs = (F.col("f") > 0) & ((F.col("s") == 0) | (F.col("h") != F.col("h_top")) | (F.col("g") != F.col("g_top")))
    one = by_identity.agg(
        repeated("s").alias(identity.name), F.abs(F.coalesce(F.sum(F.col("s") - F.col("f")), F.lit(0))).alias(counts.name),
        repeated("f").alias(grain.name), F.count_if(differs).alias(lineage.name),
    )
    return observed_rows(one, [identity, counts, grain, lineage])


def natural_key_duplicates(dims: Mapping[str, DataFrame], check: Check, natural: Mapping[str, str] | None = None) -> DataFrame:
    """Members in excess of one per natural hash, or per natural key column if given, over all dimensions."""
    keys = natural or dict.fromkeys(dims, "natural_hash")
    stacked = reduce(
        lambda a, b: a.unionAll(b), [d.select(F.lit(n).alias("dim"), F.col(keys[n]).cast("string").alias("member")) for n, d in dims.items()]
    )
    return duplicates(stacked, ("dim", "member"), check, mode="rows")


def missing_reconciliation(batches: DataFrame, runs: DataFrame, check: Check) -> DataFrame:
    """1 if some SUCCESS batch has no SUCCESS reconciliation run."""
    done = runs.where("status = 'SUCCESS'").select("batch_id")
    lost = batches.where("status = 'SUCCESS'").join(done, "batch_id", "left_anti")
    return _single(lost, check, F.when(F.count("*") > 0, 1).otherwise(0))


def required_columns(df: DataFrame, contract: Sequence[str], check: Check) -> DataFrame:
    """Columns missing from, or foreign to, the declared layout."""
    off = len(set(contract) ^ set(df.columns))
    return observed_rows(df.sparkSession.range(1).select(F.lit(off).alias(check.name)), [check])


CONTROLLED_FAILURE = Check(
    "CONTROLLED_INVALID_INPUT", "GATE_TEST", "Test row added in memory only; no table changes"
)


def verdicts(results: Sequence[DataFrame], warnings_pass: bool = False, inject_failure: bool = False) -> DataFrame:
    """Rule rows with their status, ordered by domain and rule.

    A hard rule passes only if observed equals expected; an unknown observed
    value is a failure. Warnings read ``WARNING``, or PASS/FAIL with
    ``warnings_pass``.
    """
    rows = reduce(lambda a, b: a.unionByName(b), results)
    if inject_failure:
        one = rows.sparkSession.range(1).select(F.lit(1).alias(CONTROLLED_FAILURE.name))
        rows = rows.unionByName(observed_rows(one, [CONTROLLED_FAILURE]))
    status = F.when(F.col("observed") == F.col("expected"), "PASS").otherwise("FAIL")
    if not warnings_pass:
        status = F.when(F.col("severity") == WARNING, WARNING).otherwise(status)
    return rows.withColumn("status", status).orderBy("domain", "rule_name")


def run_gate(results: DataFrame, label: str, log_path: str | None = None) -> list:
    """Runs the gate once, appends its verdicts to the log, then raises if a hard rule failed."""
    rows = results.collect()  # one row for each rule
    if log_path:
        stored = results.sparkSession.createDataFrame(rows, results.schema)
        stored.withColumns({"run_label": F.lit(label), "run_at": F.current_timestamp()}).coalesce(1).write.mode("append").parquet(log_path)
    failed = [r.rule_name for r in rows if r.severity == HARD and r.status != "PASS"]
    if failed:
        raise QualityGateError(f"{label}: hard rules failed: {', '.join(failed)}")
    return rows


# --- the two gates ---------------------------------------------------------

STG, DWH = "STAGING", "WAREHOUSE"
MEASURES = (
    "expos_total", "expos_fire_rob", "prem_total", "prem_fire_rob", "sum_ins_avg",
    *[f"claim_{m}_{k}" for m in ("nb", "amount") for k in ("rob", "partcoll", "totcoll", "fire", "other")],
)


def any_of(conditions: Iterable[str]) -> str:
    return " OR ".join(f"({c})" for c in conditions)


RISK_ROW_RULES = {
    Check("STG_REQUIRED_MEASURE_NULL", STG, "Every measure is required"): any_of(f"{c} IS NULL" for c in MEASURES),
    Check("STG_REQUIRED_NUMERIC_NONNEGATIVE", STG, "Measures must not be negative"): any_of(f"{c} < 0" for c in MEASURES),
    Check("STG_STATE_PAIR", STG, "State and its abbreviation must be null together"): (
        "(state IS NULL) <> (state_ab IS NULL)"
    ),
    Check("STG_CLAIM_COUNT_AMOUNT_PAIR", STG, "Claim count and amount must be positive together"): any_of(
        f"claim_nb_{k} = 0 AND claim_amount_{k} > 0 OR claim_nb_{k} > 0 AND claim_amount_{k} = 0"
        for k in ("rob", "partcoll", "totcoll", "fire", "other")
    ),
}
RISK_FACT_RULES = {
    Check("DWH_DERIVED_RATIO_FINITE", DWH, "Ratios must be non-negative, and set where the denominator is positive"): any_of(
        (
            "expos_total > 0 AND claim_frequency IS NULL",
            "prem_total > 0 AND loss_ratio IS NULL",
            "claim_frequency < 0",
            "loss_ratio < 0",
        )
    ),
}
COLUMNS_CHECK = Check("STG_REQUIRED_COLUMNS", STG, "Staging must have exactly its declared columns")
RISK_CHECKS = {
    "partition": Check("STG_PARTITION_RECONCILIATION", STG, "Every manifest file must have its expected rows"),
    "identity": Check("STG_TECHNICAL_IDENTITY_DUPLICATE", STG, "File and row number must be unique"),
    "mapping": Check("STG_STATE_MAPPING", STG, "State and abbreviation must map one to one"),
    "logical": Check("STG_LOGICAL_DUPLICATE_AUDIT", STG, "Repeated records are kept by technical identity", WARNING),
    "counts": Check("DWH_FACT_STAGING_RECONCILIATION", DWH, "Fact rows must equal staging rows"),
    "orphans": Check("DWH_FACT_ORPHAN_FOREIGN_KEY", DWH, "Every fact key must resolve"),
    "grain": Check("DWH_FACT_GRAIN_DUPLICATE", DWH, "Fact grain must be unique"),
    "lineage": Check("DWH_FACT_BATCH_LINEAGE", DWH, "Fact lineage must match staging"),
    "dims": Check("DWH_DIMENSION_NATURAL_HASH_UNIQUE", DWH, "Natural hashes must be unique"),
}

MARKET_REQUIRED = ("company_code", "company_name", "year_month", "product", "state", "premiums", "claims")
MARKET_ROW_RULES = {
    Check("STG_REQUIRED_FIELD_NULL", STG, "Key fields and measures are required"): any_of(
        f"{c} IS NULL" for c in MARKET_REQUIRED
    ),
    Check("STG_VALID_MONTH_START", STG, "The month must be a first day"): "day(year_month) <> 1",
}
MARKET_WARNINGS = {
    Check("STG_NEGATIVE_PREMIUMS", STG, "Negative premiums are kept for review", WARNING, None): "premiums < 0",
    Check("STG_NEGATIVE_CLAIMS", STG, "Negative claims are kept for review", WARNING, None): "claims < 0",
    Check("STG_SOURCE_RATIO_NULL", STG, "The source gave no ratio", WARNING, None): "claim_premium_ratio IS NULL",
    Check("STG_NEGATIVE_SOURCE_RATIO", STG, "Negative source ratios are kept for review", WARNING, None): (
        "claim_premium_ratio < 0"
    ),
}
MARKET_CHECKS = {
    "batches": Check("STG_SUCCESS_BATCH_RECONCILIATION", STG, "Expected = accepted + rejected = physical rows"),
    "rejects": Check("STG_REJECTED_SOURCE_ROWS", STG, "A canonical source has no rejected rows"),
    "identity": Check("STG_TECHNICAL_IDENTITY_DUPLICATE", STG, "File and row number must be unique"),
    "grain": Check("STG_BUSINESS_GRAIN_DUPLICATE", STG, "Company, month, product and state must be unique"),
    "names": Check("STG_COMPANY_NAME_MAPPING", STG, "One name per company code"),
    "counts": RISK_CHECKS["counts"],
    "orphans": RISK_CHECKS["orphans"],
    "fact_grain": RISK_CHECKS["grain"],
    "lineage": Check("DWH_FACT_STAGE_LINEAGE", DWH, "Fact lineage and measures must match staging"),
    "dims": Check("DWH_DIMENSION_NATURAL_KEY_UNIQUENESS", DWH, "Natural keys must be unique"),
    "recon": Check("RECONCILIATION_LATEST_FULL_RUN", "RECONCILIATION", "Every SUCCESS batch needs a SUCCESS reconciliation"),
}
MARKET_COMPARED = ("batch_id", "record_hash", "premiums", "claims", "claim_premium_ratio")
MARKET_NATURAL = {"month": "year_month", "company": "company_code", "product": "product", "state": "state"}


def risk_gate(
    staging: DataFrame, fact: DataFrame, dims: Mapping[str, DataFrame], manifest: DataFrame,
    known_duplicates: int = 0, inject_failure: bool = False, layout: Sequence[str] | None = None,
) -> DataFrame:
    """All risk rules; with ``layout`` also the declared staging columns."""
    c = RISK_CHECKS
    audit = Check(c["logical"].name, STG, c["logical"].detail, WARNING, known_duplicates)
    results = [
        fused_scan(staging, RISK_ROW_RULES),
        fused_scan(fact, RISK_FACT_RULES),
        partition_reconciliation(manifest, staging, c["partition"]),
        compared_layers(staging, fact, ("record_hash",), c["identity"], c["counts"], c["grain"], c["lineage"], "rows"),
        one_to_one(staging, "state", "state_ab", c["mapping"]),
        duplicates(staging, ("record_hash",), audit, mode="rows"),
        orphans(fact, dims, c["orphans"]),
        natural_key_duplicates(dims, c["dims"]),
    ]
    if layout is not None:
        results.append(required_columns(staging, layout, COLUMNS_CHECK))
    return verdicts(results, warnings_pass=True, inject_failure=inject_failure)


def market_gate(
    staging: DataFrame, rejected: DataFrame, batches: DataFrame, fact: DataFrame, dims: Mapping[str, DataFrame],
    reconciliations: DataFrame, inject_failure: bool = False, layout: Sequence[str] | None = None,
) -> DataFrame:
    """All market rules and warnings; with ``layout`` also the declared staging columns."""
    c = MARKET_CHECKS
    results = [
        fused_scan(staging, {**MARKET_ROW_RULES, **MARKET_WARNINGS}),
        batch_reconciliation(batches, staging, rejected, c["batches"]),
        _single(rejected, c["rejects"], F.count("*")),
        compared_layers(staging, fact, MARKET_COMPARED, c["identity"], c["counts"], c["fact_grain"], c["lineage"], "groups"),
        duplicates(staging, ("company_code", "year_month", "product", "state"), c["grain"]),
        several_values(staging, "company_code", "company_name", c["names"]),
        orphans(fact, dims, c["orphans"]),
        natural_key_duplicates(dims, c["dims"], MARKET_NATURAL),
        missing_reconciliation(batches, reconciliations, c["recon"]),
    ]
    if layout is not None:
        results.append(required_columns(staging, layout, COLUMNS_CHECK))
    return verdicts(results, inject_failure=inject_failure)


# --- reconciliation over three layers ---------------------------------------


def reconcile_layers(batches: DataFrame, source: DataFrame, staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows and exact totals per batch over source, staging and fact.

    Totals are compared with ``=``: subtracting wide decimals would lose scale.
    """

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("batch_id").agg(
            F.count("*").alias(f"{name}_rows"),
            F.sum("premiums").alias(f"{name}_premiums"),
            F.sum("claims").alias(f"{name}_claims"),
        )

    joined = batches
    for name, df in (("source", source), ("staging", staging), ("fact", fact)):
        joined = joined.join(totals(df, name), "batch_id", "left").fillna(0, [f"{name}_rows"])
    accepted = F.col("accepted_rows")
    holds = (
        (F.col("source_rows") == F.col("expected_source_rows"))
        & (F.col("source_rows") == accepted + F.col("rejected_rows"))
        & (F.col("staging_rows") == accepted)
        & (F.col("fact_rows") == accepted)
    )
    for measure in ("premiums", "claims"):
        holds = holds & (F.col(f"source_{measure}") == F.col(f"staging_{measure}"))
        holds = holds & (F.col(f"staging_{measure}") == F.col(f"fact_{measure}"))
    return joined.withColumn("load_status", F.col("status")).withColumn(
        "status", F.when(F.coalesce(holds, F.lit(False)), "SUCCESS").otherwise("FAILED")
    )


def precheck(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Staging and fact rows, and whether a scoring run may start."""
    signed = staging.select(F.lit("s").alias("layer")).unionAll(fact.select(F.lit("f").alias("layer")))
    counts = signed.agg(
        F.count_if(F.col("layer") == "s").alias("staging_rows"), F.count_if(F.col("layer") == "f").alias("fact_rows")
    )
    ready = (F.col("staging_rows") == F.col("fact_rows")) & (F.col("staging_rows") > 0)
    return counts.withColumn("status", F.when(ready, "PASS").otherwise("FAIL"))


class PrecheckError(RuntimeError):
    """Staging and fact do not hold the same rows, or none."""


def require_precheck(staging: DataFrame, fact: DataFrame) -> None:
    """Raises unless a training or scoring run may start."""
    row = precheck(staging, fact).first()
    if row.status != "PASS":
        raise PrecheckError(f"staging has {row.staging_rows} rows, fact {row.fact_rows}")
