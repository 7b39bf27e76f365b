"""Row contracts over the raw text views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.functions import hashing as H
from riskmart.functions import parsing as P
from riskmart.operators import row_contracts as R
from riskmart.operators import warehouse as W
from riskmart.plans.fixtures import Sources
from riskmart.plans.oracle import nul_hash
from riskmart.plans.registry import query

KEY = ("source_file", "source_row_number")

# --- oracle fragments ------------------------------------------------------


def sql_int(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '^(0|-?[1-9][0-9]*)$') THEN TRY_CAST({text} AS INT) END"


def sql_month(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '^[0-9]{{4}}-[0-9]{{2}}-01$') THEN TRY_CAST({text} AS DATE) END"


def sql_half_even(text: str) -> str:
    """Plain or exponent text of up to 38 digits; ties on an even digit are cut."""
    rx = "'^([+-]?)([0-9]*)[.]?([0-9]*)([eE][+-]?[0-9]{1,9})?$'"
    whole, part = f"regexp_extract({text}, {rx}, 2)", f"regexp_extract({text}, {rx}, 3)"
    tie = f"substr({part}, 19, 1) = '5' AND rtrim(substr({part}, 20), '0') = '' AND substr({part}, 18, 1) IN ('0','2','4','6','8')"
    cut = f"regexp_extract({text}, {rx}, 1) || {whole} || '.' || substr({part}, 1, 18)"
    valid = f"regexp_matches({text}, {rx}) AND {whole} || {part} <> ''"
    return f"CASE WHEN NOT ({valid}) THEN NULL WHEN {tie} THEN TRY_CAST({cut} AS DECIMAL(38,18)) ELSE TRY_CAST({text} AS DECIMAL(38,18)) END"


def sql_money_reason(c: str) -> str:
    return (
        f"WHEN ({sql_half_even(c)}) IS NULL THEN CASE WHEN {c} = '' THEN '{c} is required' "
        f"WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN '{c} does not fit the declared decimal' ELSE '{c} is not a finite decimal' END"
    )


MARKET_REASON = f"""CASE
 WHEN company_code = '' THEN 'company_code is required'
 WHEN NOT regexp_matches(company_code, '^(0|-?[1-9][0-9]*)$') THEN 'company_code is not a canonical integer'
 WHEN TRY_CAST(company_code AS INT) IS NULL THEN 'company_code is outside int32'
 WHEN company_name = '' THEN 'company_name is required'
 WHEN length(company_name) > 116 THEN 'company_name is longer than 116 characters'
 WHEN year_month = '' THEN 'year_month is required'
 WHEN NOT regexp_matches(year_month, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') OR TRY_CAST(year_month AS DATE) IS NULL THEN 'year_month is not an ISO date'
 WHEN day(TRY_CAST(year_month AS DATE)) <> 1 THEN 'year_month is not the first day of a month'
 WHEN product = '' THEN 'product is required' WHEN length(product) > 42 THEN 'product is longer than 42 characters'
 WHEN state = '' THEN 'state is required' WHEN length(state) > 2 THEN 'state is longer than 2 characters'
 {sql_money_reason('premiums')} {sql_money_reason('claims')}
 WHEN claim_premium_ratio <> 'NA' AND ({sql_half_even('claim_premium_ratio')}) IS NULL THEN
   CASE WHEN claim_premium_ratio = '' THEN 'claim_premium_ratio is required' ELSE 'claim_premium_ratio is not a finite decimal' END
END"""
PAYLOAD = "'{' || " + " || ',' || ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in C.MARKET_COLUMNS) + " || '}'"
MARKET_HASH = nul_hash(list(C.MARKET_COLUMNS))
CHECKED = f"SELECT *, {MARKET_REASON} AS reason FROM fx_market_raw"


# --- market ----------------------------------------------------------------


@query("contract_company_code", f"SELECT source_row_number, company_code AS text, {sql_int('company_code')} AS value FROM fx_market_raw")
def contract_company_code(src: Sources) -> DataFrame:
    text = F.col("company_code")
    return src.market_raw.select("source_row_number", text.alias("text"), P.canonical_int(text).alias("value"))


@query(
    "contract_month",
    f"SELECT source_row_number, year_month AS text, CAST({sql_month('year_month')} AS VARCHAR) AS value FROM fx_market_raw",
)
def contract_month(src: Sources) -> DataFrame:
    text = F.col("year_month")
    return src.market_raw.select("source_row_number", text.alias("text"), P.month_start(text).cast("string").alias("value"))


@query(
    "contract_required_text",
    """SELECT source_row_number, company_name <> '' AND length(company_name) <= 116 AS company_name_ok,
  product <> '' AND length(product) <= 42 AS product_ok, state <> '' AND length(state) <= 2 AS state_ok FROM fx_market_raw""",
)
def contract_required_text(src: Sources) -> DataFrame:
    rules = [R.required_text_rule(name, limit) for name, limit in C.MARKET_TEXT_LIMITS.items()]
    raw = R.with_texts(src.market_raw, C.MARKET_COLUMNS)
    return raw.select("source_row_number", *[rule.ok.alias(f"{rule.field}_ok") for rule in rules])


@query(
    "contract_ratio_na",
    f"""SELECT source_row_number, claim_premium_ratio AS text, NULLIF(claim_premium_ratio, 'NA') AS raw,
  CAST({sql_half_even("NULLIF(claim_premium_ratio, 'NA')")} AS VARCHAR) AS value,
  claim_premium_ratio = 'NA' OR ({sql_half_even('claim_premium_ratio')}) IS NOT NULL AS ok FROM fx_market_raw""",
)
def contract_ratio_na(src: Sources) -> DataFrame:
    """The ratio's rule as the contract applies it."""
    name = "claim_premium_ratio"
    text = F.col(R.text_column(name))
    parsed = P.with_plain_decimals(R.with_texts(src.market_raw, C.MARKET_COLUMNS), {R.plain_column(name): R.text_column(name)})
    typed = parsed.withColumn(name, P.half_even_decimal(F.col(R.plain_column(name))))
    return typed.select(
        "source_row_number", text.alias("text"), F.nullif(text, F.lit("NA")).alias("raw"), F.col(name).cast("string").alias("value"),
        R.decimal_rule(name, nullable_na=True).ok.alias("ok"),
    )


@query(
    "contract_decimal_half_even",
    f"""SELECT source_row_number, premiums AS premiums_raw, CAST({sql_half_even('premiums')} AS VARCHAR) AS premiums,
  claims AS claims_raw, CAST({sql_half_even('claims')} AS VARCHAR) AS claims FROM fx_market_raw""",
)
def contract_decimal_half_even(src: Sources) -> DataFrame:
    plain = P.with_plain_decimals(src.market_raw, {"premiums_plain": "premiums", "claims_plain": "claims"})
    return plain.select(
        "source_row_number",
        F.col("premiums").alias("premiums_raw"),
        P.half_even_decimal(F.col("premiums_plain")).cast("string").alias("premiums"),
        F.col("claims").alias("claims_raw"),
        P.half_even_decimal(F.col("claims_plain")).cast("string").alias("claims"),
    )


@query("record_hash_market", f"SELECT source_file, source_row_number, {MARKET_HASH} AS record_hash FROM fx_market_raw")
def record_hash_market(src: Sources) -> DataFrame:
    return src.market_checked.select(*KEY, "record_hash")


@query(
    "market_accept",
    f"""SELECT source_file, source_row_number, {MARKET_HASH} AS record_hash, CAST(company_code AS INT) AS company_code, company_name,
  year_month, product, state, premiums AS premiums_raw, CAST({sql_half_even('premiums')} AS VARCHAR) AS premiums,
  claims AS claims_raw, CAST({sql_half_even('claims')} AS VARCHAR) AS claims,
  CAST({sql_half_even("NULLIF(claim_premium_ratio, 'NA')")} AS VARCHAR) AS claim_premium_ratio
FROM ({CHECKED}) WHERE reason IS NULL""",
)
def market_accept(src: Sources) -> DataFrame:
    accepted, _ = src.market_split
    return accepted.select(
        *KEY,
        "record_hash",
        "company_code",
        "company_name",
        F.col("year_month").cast("string").alias("year_month"),
        "product",
        "state",
        "premiums_raw",
        F.col("premiums").cast("string").alias("premiums"),
        "claims_raw",
        F.col("claims").cast("string").alias("claims"),
        F.col("claim_premium_ratio").cast("string").alias("claim_premium_ratio"),
    )


@query(
    "market_rejects",
    f"""SELECT source_file, source_row_number, {MARKET_HASH} AS record_hash, {PAYLOAD} AS raw_payload,
  'row ' || CAST(source_row_number AS VARCHAR) || ': ' || reason AS reject_reason FROM ({CHECKED}) WHERE reason IS NOT NULL""",
)
def market_rejects(src: Sources) -> DataFrame:
    _, rejected = src.market_split
    return rejected.select(*KEY, "record_hash", "raw_payload", "reject_reason")


# --- risk ------------------------------------------------------------------


@query(
    "contract_optional_text",
    "SELECT source_file, source_row_number, " + ", ".join(
        f"""NULLIF("{c}", '') AS {W.RISK_STAGING_TO_SNAKE[c]}, length("{c}") <= {limit} AS {W.RISK_STAGING_TO_SNAKE[c]}_ok""" for c, limit in C.RISK_TEXT_LIMITS.items()
    ) + " FROM fx_risk_raw",
)
def contract_optional_text(src: Sources) -> DataFrame:
    columns = []
    for name, limit in C.RISK_TEXT_LIMITS.items():
        snake = W.RISK_STAGING_TO_SNAKE[name]
        columns += [F.nullif(R.text_column(name), F.lit("")).alias(snake), R.optional_text_rule(name, limit).ok.alias(f"{snake}_ok")]
    return R.with_texts(src.risk_raw, C.RISK_COLUMNS).select(*KEY, *columns)


def sql_fit(text: str, precision: int, scale: int) -> str:
    """Exact-fit test for plain literals and literals with a positive exponent."""
    rx = "'^([+-]?)([0-9]*)[.]?([0-9]*)[eE]?([0-9]*)$'"
    whole, part = f"regexp_extract({text}, {rx}, 2)", f"regexp_extract({text}, {rx}, 3)"
    power = f"coalesce(TRY_CAST(regexp_extract({text}, {rx}, 4) AS INT), 0)"
    return (
        f"regexp_matches({text}, {rx}) AND {whole} || {part} <> '' AND NOT starts_with({text}, '-')"
        f" AND length({part}) - {power} <= {scale} AND length(ltrim({whole}, '0')) + {power} <= {precision - scale}"
    )


@query(
    "contract_decimal_fit",
    "SELECT source_file, source_row_number, " + ", ".join(
        f"""{sql_fit(f'"{c}"', *shape)} AS {W.RISK_STAGING_TO_SNAKE[c]}_ok""" for c, shape in C.RISK_DECIMALS.items()
    ) + """, "ExposTotal" AS exposure_raw, "PremTotal" AS premium_raw FROM fx_risk_raw""",
)
def contract_decimal_fit(src: Sources) -> DataFrame:
    """The rule of every decimal column, as the contract applies it."""
    literals = {R.plain_column(c): P.decimal_literal(F.col(R.text_column(c))) for c in C.RISK_DECIMALS}
    typed = {c: P.exact_decimal(F.col(R.plain_column(c)), *shape) for c, shape in C.RISK_DECIMALS.items()}
    parsed = R.with_texts(src.risk_raw, C.RISK_COLUMNS).withColumns(literals).withColumns(typed)
    return parsed.select(
        *KEY, *[R.decimal_rule(c).ok.alias(f"{W.RISK_STAGING_TO_SNAKE[c]}_ok") for c in C.RISK_DECIMALS],
        F.col(R.text_column("ExposTotal")).alias("exposure_raw"), F.col(R.text_column("PremTotal")).alias("premium_raw"),
    )


def _int_sql(name: str) -> str:
    """A year may be blank-padded or missing, a count is digits alone."""
    if name == "VehYear":
        return """CASE WHEN TRY_CAST(trim("VehYear") AS BIGINT) BETWEEN 0 AND 32767 THEN TRY_CAST(trim("VehYear") AS INT) END"""
    return f"""CASE WHEN regexp_matches("{name}", '^[0-9]+$') AND CAST("{name}" AS BIGINT) <= 2147483647 THEN CAST("{name}" AS INT) END"""


_INTEGERS = ("VehYear", *C.RISK_COUNTS)


@query(
    "contract_nonneg_int",
    "SELECT source_file, source_row_number, " + ", ".join(f'"{c}" AS {W.RISK_STAGING_TO_SNAKE[c]}_raw, {_int_sql(c)} AS {W.RISK_STAGING_TO_SNAKE[c]}' for c in _INTEGERS) + " FROM fx_risk_raw",
)
def contract_nonneg_int(src: Sources) -> DataFrame:
    columns = []
    for name in _INTEGERS:
        snake, kind = W.RISK_STAGING_TO_SNAKE[name], "smallint" if name == "VehYear" else "int"
        columns += [F.col(name).alias(f"{snake}_raw"), P.nonneg_int(F.col(name), kind).alias(snake)]
    return src.risk_raw.select(*KEY, *columns)


@query(
    "contract_pair_null",
    """SELECT source_file, count(*) AS rows, count_if(("State" = '') <> ("StateAb" = ''))::BIGINT AS broken_pairs FROM fx_risk_raw GROUP BY 1""",
)
def contract_pair_null(src: Sources) -> DataFrame:
    broken = (F.col("State") == "") != (F.col("StateAb") == "")
    return src.risk_raw.groupBy("source_file").agg(F.count("*").alias("rows"), F.count_if(broken).alias("broken_pairs"))


_JSON_FIELDS = []
for _name in C.RISK_COLUMNS:
    _column = W.RISK_STAGING_TO_SNAKE[_name]
    if _name in C.RISK_DECIMALS:
        _body = f"'\"' || CAST({_column} AS VARCHAR) || '\"'"
    elif _name in C.RISK_TEXT_LIMITS:
        _body = f"CASE WHEN {_column} IS NULL THEN 'null' ELSE '\"' || {_column} || '\"' END"
    else:
        _body = f"coalesce(CAST({_column} AS VARCHAR), 'null')"
    _JSON_FIELDS.append(f"'[\"{_name}\",' || {_body} || ']'")
RISK_TYPED_HASH = "upper(sha256('[' || " + " || ',' || ".join(_JSON_FIELDS) + " || ']'))"


@query("record_hash_risk", f"SELECT source_file, source_row_number, {RISK_TYPED_HASH} AS record_hash FROM fx_risk")
def record_hash_risk(src: Sources) -> DataFrame:
    """Hash of the parsed values, decimals in plain notation."""
    fields = []
    for name in C.RISK_COLUMNS:
        kind = "decimal" if name in C.RISK_DECIMALS else "text" if name in C.RISK_TEXT_LIMITS else "int"
        fields.append((name, kind, F.col(W.RISK_STAGING_TO_SNAKE[name]).cast("string")))
    return src.risk.select(*KEY, H.typed_record_hash(fields).alias("record_hash"))


RISK_BAD = f"""CASE WHEN length("Gender") > 20 THEN 'Gender is longer than 20 characters'
 WHEN "VehYear" <> '' AND (TRY_CAST(trim("VehYear") AS BIGINT) IS NULL OR TRY_CAST(trim("VehYear") AS BIGINT) NOT BETWEEN 0 AND 32767)
   THEN 'VehYear is not a non-negative 16-bit integer'
 WHEN NOT ({sql_fit('"ExposTotal"', 21, 17)}) THEN 'ExposTotal does not fit the declared decimal'
 WHEN "PremTotal" = '' THEN 'PremTotal is required' WHEN "PremTotal" = 'Infinity' THEN 'PremTotal is not a finite decimal'
 WHEN NOT regexp_matches("ClaimNbRob", '^[0-9]+$') OR TRY_CAST("ClaimNbRob" AS BIGINT) > 2147483647
   THEN 'ClaimNbRob is not a non-negative 32-bit integer'
 WHEN ("State" = '') <> ("StateAb" = '') THEN 'State and StateAb must be null together' END"""


@query(
    "risk_contract_violations",
    f"""SELECT source_file, count(*) AS source_rows, count(bad)::BIGINT AS bad_rows,
  min(CASE WHEN bad IS NOT NULL THEN source_row_number END) AS first_bad_row,
  'row ' || CAST(min(CASE WHEN bad IS NOT NULL THEN source_row_number END) AS VARCHAR) || ': ' ||
    arg_min(bad, source_row_number) FILTER (WHERE bad IS NOT NULL) AS first_reason
FROM (SELECT *, {RISK_BAD} AS bad FROM fx_risk_raw) GROUP BY source_file""",
)
def risk_contract_violations(src: Sources) -> DataFrame:
    return R.contract_violations(src.risk_checked)

