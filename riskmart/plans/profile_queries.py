"""Column profiles of both tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.contracts import MARKET_COLUMNS, NULL_SENTINELS, RISK_DECIMALS
from riskmart.functions import parsing as P
from riskmart.operators import profiling as R
from riskmart.plans.fixtures import RISK_ATTRIBUTES, Sources
from riskmart.plans.registry import query

TEXTS = ("company_name", "product", "state")
NUMBERS = ("premiums", "claims", "claim_premium_ratio")
QUANTILE_COLUMNS = ("expos_total", "prem_total", "claim_amount_rob", "claim_amount_other", "veh_year")


def _stack(table: str, columns: tuple[str, ...]) -> str:
    return "(" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {table}" for c in columns) + ")"


_SENTINELS = ", ".join(f"'{s}'" for s in NULL_SENTINELS)
_RX = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,9})?$'"
# Values beyond any decimal column and beyond int64, for the profiles that must take them as they are.
_HUGE = {19: "123456789012345678901.5", 20: "1e-100", 21: "0.0000000000000000004", 22: "-98765432109876543210987654321098765432109876543210"}
_LONG_CODE = "12345678901234567890"
_PLAIN = "CASE value WHEN '1e-5' THEN '0.00001' WHEN '1e-100' THEN '0.' || repeat('0', 99) || '1' ELSE value END"
_RAW_HUGE = (
    "(SELECT * REPLACE (CASE source_row_number % 97 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _HUGE.items())
    + f" ELSE premiums END AS premiums, CASE source_row_number % 97 WHEN 19 THEN '{_LONG_CODE}' WHEN 20 THEN '-{_LONG_CODE}' ELSE company_code END AS company_code) FROM fx_market_raw)"
)
_POWER = 130  # the oracle's numbers are whole multiples of 10^-130


def _shown(number: str) -> str:
    """Shortest plain notation of a whole number of 10^-130."""
    bare = f"ltrim(CAST({number} AS VARCHAR), '-')"
    digits = f"lpad({bare}, greatest(length({bare}), {_POWER + 1})::INT, '0')"
    plain = f"rtrim(rtrim(left({digits}, length({digits}) - {_POWER}) || '.' || right({digits}, {_POWER}), '0'), '.')"
    return f"CASE WHEN CAST({number} AS VARCHAR) LIKE '-%' THEN '-' ELSE '' END || {plain}"


def _huge(src: Sources) -> DataFrame:
    slot, code = F.col("source_row_number") % 97, F.lit(_LONG_CODE)
    premiums = F.col("premiums")
    for at, value in _HUGE.items():
        premiums = F.when(slot == at, value).otherwise(premiums)
    codes = F.when(slot == 19, code).when(slot == 20, F.concat(F.lit("-"), code)).otherwise(F.col("company_code"))
    return src.market_raw.withColumns({"premiums": premiums, "company_code": codes})


@query(
    "profile_numeric_text",
    f"""WITH t AS (SELECT column_name, {_PLAIN} AS value, CASE WHEN column_name = 'claim_premium_ratio' THEN upper(value) IN ({_SENTINELS}) ELSE value = '' END AS blank,
  regexp_matches(value, {_RX}) AS good FROM {_stack(_RAW_HUGE, NUMBERS)}),
p AS (SELECT *, CASE WHEN value LIKE '-%' THEN '-' ELSE '' END AS sign, ltrim(split_part(ltrim(value, '+-'), '.', 1), '0') AS whole, split_part(ltrim(value, '+-'), '.', 2) AS frac FROM t),
v AS (SELECT *, CASE WHEN good THEN CAST(sign || whole || rpad(frac, {_POWER}, '0') AS BIGNUM) END AS number,
  CASE WHEN good THEN CASE WHEN ltrim(whole || frac, '0') = '' THEN greatest(1 - length(frac), 0) ELSE length(whole) END END AS iw, CASE WHEN good THEN length(frac) END AS places FROM p)
SELECT column_name, count_if(good)::BIGINT AS present_count, count_if(blank)::BIGINT AS null_count, count_if(NOT good AND NOT blank)::BIGINT AS invalid_count,
  count_if(good AND sign = '-' AND ltrim(whole || frac, '0') <> '')::BIGINT AS negative_count, count_if(good AND ltrim(whole || frac, '0') = '')::BIGINT AS zero_count,
  {_shown('min(number)')} AS min, {_shown('max(number)')} AS max, {_shown('sum(number)')} AS sum,
  CAST(max(iw) AS INT) AS max_integer_digits, CAST(max(places) AS INT) AS max_scale_digits,
  'DECIMAL(' || least(38, greatest(1, max(iw) + max(places))) || ',' || max(places) || ')' AS suggested_type FROM v GROUP BY column_name""",
)
def profile_numeric_text(src: Sources) -> DataFrame:
    """Only the ratio has spellings of null beside the blank."""
    return R.numeric_text_profile(_huge(src), {"premiums": ("",), "claims": ("",), "claim_premium_ratio": NULL_SENTINELS})


@query(
    "profile_text",
    f"""SELECT column_name, count_if(trim(value) = '')::BIGINT AS null_count, count(DISTINCT trim(value)) FILTER (WHERE trim(value) <> '') AS cardinality,
  CAST(max(length(trim(value))) AS INT) AS max_length FROM {_stack('fx_market_raw', TEXTS)} GROUP BY 1""",
)
def profile_text(src: Sources) -> DataFrame:
    return R.text_profile(src.market_raw, TEXTS)


@query(
    "profile_topk",
    f"""SELECT column_name, value, "count", CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY "count" DESC, value) AS rank FROM (
  SELECT column_name, value, count(*) AS "count" FROM {_stack('fx_risk', RISK_ATTRIBUTES)} WHERE value IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 10""",
)
def profile_topk(src: Sources) -> DataFrame:
    return R.top_values(src.risk, RISK_ATTRIBUTES)


_DAY = "CASE WHEN regexp_matches(year_month, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN TRY_CAST(year_month AS DATE) END"
_CODE = "TRY_CAST(company_code AS HUGEINT)"


@query(
    "profile_dates",
    f"""SELECT 'year_month' AS column_name, count_if(year_month = '')::BIGINT AS null_count, count_if(year_month <> '' AND {_DAY} IS NULL)::BIGINT AS invalid_count,
  CAST(min({_DAY}) AS VARCHAR) AS min, CAST(max({_DAY}) AS VARCHAR) AS max, CAST(NULL AS BIGINT) AS cardinality FROM fx_market_raw
UNION ALL SELECT 'company_code', count_if(company_code = '')::BIGINT, count_if(company_code <> '' AND {_CODE} IS NULL)::BIGINT, CAST(min({_CODE}) AS VARCHAR), CAST(max({_CODE}) AS VARCHAR),
  count(DISTINCT {_CODE}) FROM {_RAW_HUGE}""",
)
def profile_dates(src: Sources) -> DataFrame:
    dates = R.date_profile(src.market_raw, "year_month").withColumn("cardinality", F.lit(None).cast("bigint"))
    return dates.unionByName(R.code_profile(_huge(src), "company_code"))


@query(
    "profile_invalid_values",
    f"SELECT 'year_month' AS column_name, year_month AS value, count(*) AS \"count\" FROM fx_market_raw WHERE year_month <> '' AND {_DAY} IS NULL GROUP BY 2",
)
def profile_invalid_values(src: Sources) -> DataFrame:
    return R.invalid_values(src.market_raw, "year_month", P.iso_date(F.col("year_month")))


@query(
    "profile_sentinels",
    f"""SELECT column_name, CASE WHEN value = '' THEN '<empty>' ELSE value END AS sentinel, count(*) AS "count" FROM {_stack('fx_market_raw', MARKET_COLUMNS)}
WHERE upper(value) IN ({_SENTINELS}) GROUP BY 1, 2""",
)
def profile_sentinels(src: Sources) -> DataFrame:
    return R.sentinel_counts(src.market_raw, MARKET_COLUMNS)


def _dup_sql(table: str, keys: str, name: str) -> str:
    return f"""SELECT '{name}' AS key, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, count_if(n > 1)::BIGINT AS duplicate_groups,
  CAST(sum(n - 1) AS BIGINT) AS excess_rows, sum(n - 1) = 0 AS is_unique FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"""


@query("profile_duplicates", _dup_sql("fx_risk", "record_hash", "record_hash") + " UNION ALL " + _dup_sql("fx_risk", ", ".join(RISK_ATTRIBUTES), "attributes"))
def profile_duplicates(src: Sources) -> DataFrame:
    records = R.duplicate_profile(src.risk, ("record_hash",)).withColumn("key", F.lit("record_hash"))
    return records.unionByName(R.duplicate_profile(src.risk, RISK_ATTRIBUTES).withColumn("key", F.lit("attributes")))


@query(
    "profile_candidate_key",
    _dup_sql("fx_market_raw", "company_code, year_month, product, state", "grain") + " UNION ALL "
    + _dup_sql("fx_market_raw", "company_code, year_month", "company_month"),
)
def profile_candidate_key(src: Sources) -> DataFrame:
    grain = R.duplicate_profile(src.market_raw, ("company_code", "year_month", "product", "state")).withColumn("key", F.lit("grain"))
    coarse = R.duplicate_profile(src.market_raw, ("company_code", "year_month")).withColumn("key", F.lit("company_month"))
    return grain.unionByName(coarse)


_TYPES = {"veh_year": "int"}


@query(
    "profile_missing",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{_TYPES.get(c, "string")}' AS physical_type, count(*) AS rows, count_if({c} IS NULL)::BIGINT AS missing_count,
  round(100.0 * count_if({c} IS NULL) / count(*), 6) AS missing_percent FROM fx_risk"""
        for c in RISK_ATTRIBUTES
    ),
)
def profile_missing(src: Sources) -> DataFrame:
    return R.missing_profile(src.risk, RISK_ATTRIBUTES).withColumn("missing_percent", F.round("missing_percent", 6))


_LEVELS = ", ".join(str(q) for q in R.QUANTILES)


@query(
    "profile_quantiles",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, unnest([{_LEVELS}])::DOUBLE AS level, round(unnest(quantile_cont(CAST({c} AS DOUBLE), [{_LEVELS}])), 6) AS value FROM fx_risk"""
        for c in QUANTILE_COLUMNS
    ),
)
def profile_quantiles(src: Sources) -> DataFrame:
    return R.exact_quantiles(src.risk, QUANTILE_COLUMNS).withColumn("value", F.round("value", 6))


def _stats_sql(table: str, column: str, extra: str = "") -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, count(*) AS rows_seen, count({column}) AS valid_count, count_if({column} IS NULL)::BIGINT AS missing_count,
  count_if({column} < 0)::BIGINT AS negative_count, count_if({column} = 0)::BIGINT AS zero_count, round(min({v}), 4) AS min, round(max({v}), 4) AS max, round(avg({v}), 4) AS mean{extra} FROM {table}"""


def _rounded_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("min", "max", "mean")})


@query("profile_numeric", "\nUNION ALL ".join(_stats_sql("fx_risk", c) for c in QUANTILE_COLUMNS))
def profile_numeric(src: Sources) -> DataFrame:
    return _rounded_stats(R.numeric_stats(src.risk, QUANTILE_COLUMNS))


_YES_NO = """, (SELECT count_if(has_claim = 1)::BIGINT FROM fact_risk) AS has_claim_yes, (SELECT count_if(has_claim = 0)::BIGINT FROM fact_risk) AS has_claim_no,
  (SELECT count_if(has_claim IS NULL)::BIGINT FROM fact_risk) AS has_claim_missing"""


@query(
    "profile_derived",
    "\nUNION ALL ".join(_stats_sql("fact_risk", c, _YES_NO) for c in ("total_claim_count", "total_claim_amount", "claim_frequency", "loss_ratio")),
)
def profile_derived(src: Sources) -> DataFrame:
    return _rounded_stats(R.derived_profile(src.fact_risk))


_CROSS = {
    "exposure_not_positive": "expos_total <= 0",
    "premium_not_positive": "prem_total <= 0",
    "amount_without_count": "claim_amount_rob + claim_amount_other > 0 AND claim_nb_rob + claim_nb_other = 0",
    "count_without_amount": "claim_nb_rob + claim_nb_other > 0 AND claim_amount_rob + claim_amount_other = 0",
    "partial_exposure_exceeds_total": "expos_fire_rob > expos_total",
    "partial_premium_exceeds_total": "prem_fire_rob > prem_total",
}


@query("profile_cross_field", "\nUNION ALL ".join(f"SELECT '{k}' AS observation, count_if({v})::BIGINT AS rows FROM fx_risk" for k, v in _CROSS.items()))
def profile_cross_field(src: Sources) -> DataFrame:
    return R.cross_field_profile(src.risk)


@query(
    "profile_partition_dups",
    """SELECT source_file, count(*) AS rows, count_if(r > 1)::BIGINT AS duplicate_rows FROM (
  SELECT source_file, row_number() OVER (PARTITION BY gender, driv_age, veh_group, area ORDER BY source_file, source_row_number) AS r FROM fx_risk) GROUP BY 1""",
)
def profile_partition_dups(src: Sources) -> DataFrame:
    """Records taken as (gender, age, group, area), so that many repeat across files."""
    key = F.to_json(F.struct("gender", "driv_age", "veh_group", "area"))
    return R.partition_duplicates(src.risk.select("source_file", key.alias("record")), "record")


_RISK_DECIMALS = tuple(RISK_DECIMALS)
_WIDE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, source_file, source_row_number, CASE WHEN source_row_number % 211 = 20 THEN '1e-100' ELSE "{c}" END AS value FROM fx_risk_raw"""
    for c in _RISK_DECIMALS
)


@query(
    "profile_precision",
    f"""WITH t AS (SELECT column_name, source_file, source_row_number, CASE value WHEN '1.5e3' THEN '1500.' WHEN '1e-100' THEN '0.' || repeat('0', 99) || '1' ELSE value END AS value FROM ({_WIDE})),
v AS (SELECT *, CASE WHEN regexp_matches(value, {_RX}) THEN greatest(1, length(regexp_extract(value, '^-?0*([0-9]*)', 1))) END AS whole,
  CASE WHEN regexp_matches(value, {_RX}) THEN length(regexp_extract(value, '[.]([0-9]*)', 1)) END AS places FROM t),
m AS (SELECT column_name, count(*) AS rows, count_if(places IS NULL)::BIGINT AS parse_errors, CAST(max(whole) AS INT) AS max_integer_digits, CAST(max(places) AS INT) AS max_fraction_digits FROM v GROUP BY 1)
SELECT m.*, f.source_file AS fraction_file, f.source_row_number AS fraction_row, i.source_file AS integer_file, i.source_row_number AS integer_row,
  'DECIMAL(' || (max_integer_digits + max_fraction_digits) || ',' || max_fraction_digits || ')' AS recommended_type
FROM m LEFT JOIN LATERAL (SELECT source_file, source_row_number FROM v WHERE v.column_name = m.column_name AND places = max_fraction_digits ORDER BY 1, 2 LIMIT 1) f ON true
LEFT JOIN LATERAL (SELECT source_file, source_row_number FROM v WHERE v.column_name = m.column_name AND whole = max_integer_digits ORDER BY 1, 2 LIMIT 1) i ON true""",
)
def profile_precision(src: Sources) -> DataFrame:
    tiny = {c: F.when(F.col("source_row_number") % 211 == 20, "1e-100").otherwise(F.col(c)) for c in _RISK_DECIMALS}
    return R.precision_profile(src.risk_raw.withColumns(tiny), _RISK_DECIMALS)
