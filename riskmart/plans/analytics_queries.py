"""KPIs, comparisons, rankings, bands and explorer pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.contracts import UNKNOWN_EXPORT_LABEL, UNKNOWN_LABEL
from riskmart.functions import formatting as T
from riskmart.operators import analytics as A
from riskmart.operators import marts as M
from riskmart.plans.fixtures import Sources
from riskmart.plans.registry import query

STATE, YEARS = "07", (1996, 2000)
AGES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "Unknown")
SELECTIONS = (("ALL", (1996, 2001)), ("07", (1998, 2001)), ("ALL", (2001, 2001)), ("12", (1998, 1998)), ("ALL", (1999, 1999)))
YEAR = "CAST(substr(month, 1, 4) AS INT)"


def sql_label(column: str) -> str:
    return f"CASE WHEN {column} = '{UNKNOWN_LABEL}' THEN '{UNKNOWN_EXPORT_LABEL}' ELSE {column} END"


def sql_where(state: str, years: tuple[int, int], year: str = YEAR) -> str:
    return f"{year} BETWEEN {years[0]} AND {years[1]}" + ("" if state == "ALL" else f" AND state = '{state}'")


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("market_filter", f"SELECT month, state, premium, claims, observations, {YEAR} AS year FROM mart_monthly WHERE {sql_where(STATE, YEARS)}")
def market_filter(src: Sources) -> DataFrame:
    return A.select_market(src.monthly, STATE, YEARS)


@query("risk_filter", f"SELECT * FROM mart_segments WHERE state = '{STATE}'")
def risk_filter(src: Sources) -> DataFrame:
    return A.select_risk(src.segments, STATE)


@query("market_export_rows", f"SELECT month, state, premium, claims, observations, {YEAR} AS year FROM mart_monthly WHERE {sql_where('ALL', YEARS)}")
def market_export_rows(src: Sources) -> DataFrame:
    return A.select_market(src.monthly, "ALL", YEARS)


@query(
    "risk_export_rows",
    f"""SELECT {sql_label('state')} AS state, {sql_label('gender')} AS gender, {sql_label('age')} AS age, observations, exposure, premium,
  claim_count, claims, has_claim FROM mart_segments""",
)
def risk_export_rows(src: Sources) -> DataFrame:
    return A.export_segments(src.segments)


def _kpi_sql(state: str, years: tuple[int, int]) -> str:
    return f"""SELECT '{state} {years[0]}-{years[1]}' AS selection, round(coalesce(sum(premium), 0), 2) AS premium, round(coalesce(sum(claims), 0), 2) AS claims,
  CAST(coalesce(sum(observations), 0) AS BIGINT) AS observations,
  CASE WHEN sum(premium) > 0 THEN round(sum(claims) / sum(premium), 6) END AS claim_ratio FROM mart_monthly WHERE {sql_where(state, years)}"""


@query("market_kpis", "\nUNION ALL ".join(_kpi_sql(*s) for s in SELECTIONS))
def market_kpis(src: Sources) -> DataFrame:
    parts = []
    for state, years in SELECTIONS:
        kpis = A.market_kpis(A.select_market(src.monthly, state, years))
        parts.append(kpis.withColumn("selection", F.lit(f"{state} {years[0]}-{years[1]}")))
    return _rounded(_rounded(reduce(DataFrame.unionByName, parts), 2, "premium", "claims"), 6, "claim_ratio")


def _comparison_sql(state: str, years: tuple[int, int]) -> str:
    first, latest = years
    base = first if first < latest else latest - 1
    low, high = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', low * 3 - 2, 3)", "substr('JanFebMarAprMayJunJulAugSepOctNovDec', high * 3 - 2, 3)"
    span = f"CASE WHEN months = 1 THEN {low} ELSE {low} || '–' || {high} END"
    where = "" if state == "ALL" else f" AND state = '{state}'"
    side = "(SELECT CAST(substr(month, 6, 2) AS INT) AS m, sum(premium) AS p, sum(claims) AS c, sum(observations) AS o FROM mart_monthly WHERE {y} = {v}{w} GROUP BY 1)"
    now, old = side.format(y=YEAR, v=latest, w=where), side.format(y=YEAR, v=base, w=where)
    return f"""SELECT '{state} {first}-{latest}' AS selection,
  CASE WHEN months = high - low + 1 THEN {span} || ' {latest} vs ' || {span} || ' {base}' ELSE '{latest} vs {base} · ' || months || ' matched months' END AS period,
  round(100 * (np / op - 1), 6) AS premium_change, round(100 * (nc / np - oc / op), 6) AS ratio_change_pp,
  CASE WHEN oc > 0 THEN round(100 * (nc / oc - 1), 6) END AS claims_change, CASE WHEN oo > 0 THEN round(100 * (no / oo - 1), 6) END AS observations_change
FROM (SELECT sum(n.p) AS np, sum(n.c) AS nc, sum(n.o) AS no, sum(b.p) AS op, sum(b.c) AS oc, sum(b.o) AS oo, count(*) AS months,
  count_if(b.p IS NULL) AS gaps, min(m) AS low, max(m) AS high FROM {now} n LEFT JOIN {old} b USING (m))
WHERE months > 0 AND gaps = 0 AND np > 0 AND op > 0"""


def _comparisons(src: Sources) -> DataFrame:
    parts = []
    for state, years in SELECTIONS:
        selected = A.select_market(src.monthly, state, years)
        compared = A.range_comparison(selected, src.monthly, state, years)
        parts.append(compared.withColumn("selection", F.lit(f"{state} {years[0]}-{years[1]}")))
    return reduce(DataFrame.unionByName, parts)


COMPARISON_SQL = "\nUNION ALL ".join(_comparison_sql(*s) for s in SELECTIONS)
CHANGES = ("premium_change", "ratio_change_pp", "claims_change", "observations_change")


@query("market_range_comparison", COMPARISON_SQL)
def market_range_comparison(src: Sources) -> DataFrame:
    return _rounded(_comparisons(src), 6, *CHANGES)


@query(
    "change_direction",
    f"""SELECT state, year, CASE WHEN r > 0 THEN 'up' WHEN r < 0 THEN 'down' WHEN r = 0 THEN 'flat' END AS direction FROM (
  SELECT state, year, round(100 * (p / lag(p) OVER (PARTITION BY state ORDER BY year) - 1), 1) AS r FROM (
    SELECT state, {YEAR} AS year, sum(premium) AS p FROM mart_monthly GROUP BY 1, 2))""",
)
def change_direction(src: Sources) -> DataFrame:
    """Direction of the premium change against the previous year the mart holds."""
    yearly = A.with_year(src.monthly).groupBy("state", "year").agg(F.sum("premium").alias("premium"))
    before = F.lag("premium").over(Window.partitionBy("state").orderBy("year"))
    return yearly.select("state", "year", T.change_direction(100 * (F.col("premium") / before - 1)).alias("direction"))


def _trend_sql(period: str) -> str:
    return f"SELECT {period} AS period, round(sum(premium), 2) AS premium, round(sum(claims), 2) AS claims FROM mart_monthly WHERE {sql_where(STATE, YEARS)} GROUP BY 1 ORDER BY 1"


@query("market_trend_monthly", _trend_sql("month"))
def market_trend_monthly(src: Sources) -> DataFrame:
    return _rounded(A.trend(A.select_market(src.monthly, STATE, YEARS)), 2, "premium", "claims")


@query("market_trend_annual", _trend_sql("substr(month, 1, 4)"))
def market_trend_annual(src: Sources) -> DataFrame:
    return _rounded(A.trend(A.select_market(src.monthly, STATE, YEARS), annual=True), 2, "premium", "claims")


def _top_sql(mart: str, entity: str, limit: int, name: str) -> str:
    where = sql_where(STATE, YEARS, "year")
    return f"""SELECT t.{entity}, round(p, 2) AS premium, round(100 * p / (SELECT sum(premium) FROM {mart} WHERE {where}), 6) AS share, {name}
FROM (SELECT {entity}, sum(premium) AS p FROM {mart} WHERE {where} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {limit}) t"""


def _labelled(src: Sources, frame: DataFrame, entity: str, limit: int) -> DataFrame:
    ranked = A.top_entities(A.select_market(frame, STATE, YEARS), entity, limit)
    return _rounded(_rounded(A.with_labels(ranked, M.lookup_names(src.market_dims), entity), 2, "premium"), 6, "share")


@query("top_companies", _top_sql("mart_companies", "company", 10, "company_name AS label, company_name AS short_label") + " JOIN dim_company ON company_key = t.company")
def top_companies(src: Sources) -> DataFrame:
    return _labelled(src, src.companies, "company", 10)


@query("top_products", _top_sql("mart_products", "product", 8, "d.product || ' · Product line ' || d.product AS label, 'Line ' || d.product AS short_label") + " JOIN dim_product d ON product_key = t.product")
def top_products(src: Sources) -> DataFrame:
    return _labelled(src, src.products, "product", 8)


def _concentration_sql(mart: str, entity: str, limit: int) -> str:
    where = sql_where(STATE, YEARS, "year")
    return f"""SELECT '{entity}' AS entity, round(sum(p), 2) AS top_premium, round(sum(p) / (SELECT sum(premium) FROM {mart} WHERE {where}), 6) AS share
FROM (SELECT {entity}, sum(premium) AS p FROM {mart} WHERE {where} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {limit})"""


@query("concentration", _concentration_sql("mart_companies", "company", 10) + "\nUNION ALL " + _concentration_sql("mart_products", "product", 3))
def concentration(src: Sources) -> DataFrame:
    companies = A.concentration(A.select_market(src.companies, STATE, YEARS), "company", 10)
    products = A.concentration(A.select_market(src.products, STATE, YEARS), "product", 3)
    return _rounded(_rounded(companies.unionByName(products), 2, "top_premium"), 6, "share")


@query(
    "ranking_label",
    r"""WITH names AS (SELECT company_key, state, CASE company_key % 4 WHEN 0 THEN company_name || ' COMPANHIA DE SEGUROS GERAIS S.A. (' || state || ')'
    WHEN 1 THEN 'SEGURADORA ' || company_name || ' DO ESTADO ' || state || ' S/A' WHEN 2 THEN company_name || '  E PREVIDÊNCIA - ' ELSE company_name END AS name
  FROM (SELECT DISTINCT company AS company_key, state FROM mart_companies) JOIN dim_company USING (company_key)),
cut AS (SELECT *, trim(split_part(name, '(', 1)) AS t FROM names),
bare AS (SELECT *, regexp_replace(replace(replace(replace(replace(replace(t, 'COMPANHIA DE SEGUROS GERAIS', ''), 'COMPANHIA DE SEGUROS', ''), 'E PREVIDÊNCIA', ''), 'SEGUROS', ''), 'SEGURADORA', ''), '\s+S[./]?A[.]?\s*$', '') AS b FROM cut),
tidy AS (SELECT *, regexp_replace(regexp_replace(b, '\s+', ' ', 'g'), '^[ /-]+|[ /-]+$', '', 'g') AS s FROM bare)
SELECT company_key, state, name, CASE WHEN length(s) <= 22 THEN s ELSE rtrim(substr(s, 1, 21)) || '…' END AS short_label FROM tidy""",
)
def ranking_label(src: Sources) -> DataFrame:
    pairs = src.companies.select(F.col("company").alias("company_key"), "state").distinct()
    name, kind = F.col("company_name"), F.col("company_key") % 4
    full = (
        F.when(kind == 0, F.concat(name, F.lit(" COMPANHIA DE SEGUROS GERAIS S.A. ("), "state", F.lit(")")))
        .when(kind == 1, F.concat(F.lit("SEGURADORA "), name, F.lit(" DO ESTADO "), "state", F.lit(" S/A")))
        .when(kind == 2, F.concat(name, F.lit("  E PREVIDÊNCIA - ")))
        .otherwise(name)
    )
    named = pairs.join(src.market_dims["company"], "company_key").select("company_key", "state", full.alias("name"))
    return named.withColumn("short_label", T.company_short_label(F.col("name")))


_CODES = ("0588", "0993", "1391", "9999", "0531", "0111")


@query(
    "product_label",
    f"""WITH named AS (SELECT DISTINCT product, state, list_extract({list(_CODES)}, CAST((product - 1) % 6 + 1 AS INT)) AS code FROM mart_products)
SELECT product, state, code || ' · ' || CASE code WHEN '0588' THEN 'DPVAT motor cover' WHEN '0993' THEN 'Group life' WHEN '1391' THEN 'Life insurance'
    WHEN '0531' THEN 'Motor own damage' WHEN '0111' THEN 'Fire' ELSE 'Product line ' || code END AS label,
  CASE code WHEN '0588' THEN 'DPVAT motor' WHEN '0993' THEN 'Group life' WHEN '1391' THEN 'Life insurance'
    WHEN '0531' THEN 'Motor own damage' WHEN '0111' THEN 'Fire' ELSE 'Line ' || code END AS short_label FROM named""",
)
def product_label(src: Sources) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), ((F.col("product") - 1) % 6 + 1).cast("int"))
    named = src.products.select("product", "state", F.concat(code, F.lit(" - some name")).alias("name")).distinct()
    label = T.product_label(F.col("name"))
    return named.select("product", "state", label.alias("label"), T.product_short_label(label).alias("short_label"))


_MAGNITUDE = """CASE WHEN {v} IS NULL THEN '—' WHEN abs({v}) >= 1e12 THEN format('{{:,.2f}}T', {v} / 1e12) WHEN abs({v}) >= 1e9 THEN format('{{:,.2f}}B', {v} / 1e9)
 WHEN abs({v}) >= 1e6 THEN format('{{:,.2f}}M', {v} / 1e6) WHEN abs({v}) >= 1e3 THEN format('{{:,.2f}}K', {v} / 1e3)
 WHEN {v} <> 0 AND abs({v}) < 1 THEN format('{{:,.3f}}', {v}) ELSE format('{{:,.0f}}', {v}) END"""


@query(
    "format_magnitude",
    f"""WITH k AS (SELECT month, state, premium, claims, CASE WHEN premium > 0 THEN claims / premium END AS ratio FROM mart_monthly)
SELECT month, state, {_MAGNITUDE.format(v='premium')} AS premium_text, {_MAGNITUDE.format(v='claims')} AS claims_text, {_MAGNITUDE.format(v='ratio')} AS ratio_text,
  CASE WHEN ratio IS NULL THEN '—' ELSE format('{{:.1f}}%', ratio * 100) END AS percent_text FROM k""",
)
def format_magnitude(src: Sources) -> DataFrame:
    share = A.ratio(F.col("claims"), F.col("premium"))
    return src.monthly.select(
        "month",
        "state",
        T.format_magnitude(F.col("premium")).alias("premium_text"),
        T.format_magnitude(F.col("claims")).alias("claims_text"),
        T.format_magnitude(share).alias("ratio_text"),
        T.format_percent(share).alias("percent_text"),
    )


@query(
    "risk_kpis",
    f"""SELECT CAST(sum(observations) AS BIGINT) AS observations, round(sum(exposure), 4) AS exposure, round(sum(claim_count) / sum(exposure), 6) AS claims_per_exposure,
  (SELECT CAST(sum(observations) AS BIGINT) FROM mart_bands WHERE state = '{STATE}') AS scored,
  (SELECT round(sum(score_sum) / sum(observations), 6) FROM mart_bands WHERE state = '{STATE}') AS mean_score FROM mart_segments WHERE state = '{STATE}'""",
)
def risk_kpis(src: Sources) -> DataFrame:
    kpis = A.risk_kpis(A.select_risk(src.segments, STATE), A.select_risk(src.bands, STATE))
    return _rounded(_rounded(kpis, 4, "exposure"), 6, "claims_per_exposure", "mean_score")


_HISTOGRAM = """SELECT CAST(r.band AS INT) AS band, CAST(coalesce(n, 0) AS BIGINT) AS observations, round(coalesce(s, 0), 6) AS score_sum, CAST(coalesce(p, 0) AS BIGINT) AS positives
FROM range(20) r(band) LEFT JOIN (SELECT least(band, 19) AS band, sum(observations) AS n, sum(score_sum) AS s, sum(positives) AS p FROM mart_bands{w} GROUP BY 1) USING (band)"""


@query("score_histogram", _HISTOGRAM.format(w=f" WHERE state = '{STATE}'") + " ORDER BY band")
def score_histogram(src: Sources) -> DataFrame:
    return _rounded(A.score_histogram(A.select_risk(src.bands, STATE)), 6, "score_sum")


@query(
    "score_calibration",
    f"""SELECT band, (band + CAST(0.5 AS DOUBLE)) / 20 AS center, observations, round(100.0 * positives / nullif(observations, 0), 6) AS observed_share,
  round(100 * score_sum / nullif(observations, 0), 6) AS mean_score FROM ({_HISTOGRAM.format(w='')}) ORDER BY band""",
)
def score_calibration(src: Sources) -> DataFrame:
    return _rounded(A.score_calibration(src.bands), 6, "observed_share", "mean_score")


@query(
    "score_groups",
    """SELECT CAST(sum(observations) AS BIGINT) AS population, CAST(sum(observations) FILTER (WHERE band < 4) AS BIGINT) AS low_observations,
  round(sum(observations) FILTER (WHERE band < 4) / sum(observations), 6) AS low_share,
  round(sum(positives) FILTER (WHERE band < 4) / sum(observations) FILTER (WHERE band < 4), 6) AS low_claim_share,
  CAST(sum(observations) FILTER (WHERE band >= 10) AS BIGINT) AS high_observations,
  round(sum(positives) FILTER (WHERE band >= 10) / sum(observations) FILTER (WHERE band >= 10), 6) AS high_claim_share FROM mart_bands""",
)
def score_groups(src: Sources) -> DataFrame:
    return _rounded(A.score_groups(src.bands), 6, "low_share", "low_claim_share", "high_claim_share")


@query(
    "age_share",
    f"""SELECT CAST(list_position({list(AGES)}, age) - 1 AS INT) AS position, age, CAST(sum(observations) AS BIGINT) AS observations,
  CAST(sum(has_claim) AS BIGINT) AS has_claim, round(100.0 * sum(has_claim) / sum(observations), 6) AS share,
  (SELECT round(100.0 * sum(has_claim) / sum(observations), 6) FROM mart_segments) AS overall_share
FROM (SELECT {sql_label('age')} AS age, observations, has_claim FROM mart_segments) GROUP BY age ORDER BY 1""",
)
def age_share(src: Sources) -> DataFrame:
    return _rounded(A.age_share(src.segments, AGES), 6, "share", "overall_share")


@query(
    "gender_mix",
    f"""SELECT {sql_label('gender')} AS gender, CAST(sum(observations) AS BIGINT) AS observations,
  round(100.0 * sum(observations) / (SELECT sum(observations) FROM mart_segments), 6) AS share FROM mart_segments GROUP BY 1 ORDER BY 2, 1""",
)
def gender_mix(src: Sources) -> DataFrame:
    return _rounded(A.gender_mix(src.segments), 6, "share")


@query(
    "explorer_market",
    """SELECT month, state, premium, claims, observations, CASE WHEN premium > 0 THEN round(claims / premium, 6) END AS share
FROM mart_monthly ORDER BY month DESC, state LIMIT 15 OFFSET 30""",
)
def explorer_market(src: Sources) -> DataFrame:
    return _rounded(A.explorer_page(src.monthly, "market", page=2), 6, "share")


@query(
    "explorer_risk",
    f"""WITH shown AS (SELECT {sql_label('state')} AS state, {sql_label('gender')} AS gender, {sql_label('age')} AS age, observations, exposure, premium, claim_count,
  claims, has_claim, round(has_claim / observations, 6) AS share, row_number() OVER (ORDER BY observations DESC, {sql_label('state')}, {sql_label('gender')}, {sql_label('age')}) AS pos,
  count(*) OVER () AS n FROM mart_segments)
SELECT * EXCLUDE (pos, n) FROM shown WHERE pos > ((n + 14) // 15 - 1) * 15""",
)
def explorer_risk(src: Sources) -> DataFrame:
    """A page number far past the end shows the last page."""
    return _rounded(A.explorer_page(src.segments, "risk", page=99_999), 6, "share")


@query(
    "platform_kpis",
    """WITH w AS (SELECT 'Company / month' AS workload, count(*) AS before_reads, count_if(calendar_year >= 2000) AS after_reads FROM fact_market
  UNION ALL SELECT 'State / product / month', count(*), count_if(calendar_year >= 2001) FROM fact_market)
SELECT workload, round(100 * (1 - after_reads / before_reads), 6) AS read_reduction,
  (SELECT count(*) FROM fact_market) + (SELECT count(*) FROM fact_risk) AS observations,
  CAST(CASE WHEN (SELECT count(*) FROM fx_market) = (SELECT count(*) FROM fact_market) THEN 1 ELSE 0 END
    + CASE WHEN (SELECT count(*) FROM fx_risk) = (SELECT count(*) FROM fact_risk) THEN 1 ELSE 0 END AS INT) AS tracks_matched FROM w""",
)
def platform_kpis(src: Sources) -> DataFrame:
    """Rows a year-partitioned fact spares the two hot workloads."""
    def workload(name: str, year: int) -> DataFrame:
        return src.fact_market.agg(
            F.lit(name).alias("workload"),
            F.count("*").alias("before_reads"),
            F.count_if(F.col("calendar_year") >= year).alias("after_reads"),
        )

    counts = M.layer_counts(
        market_staging=src.market, market_fact=src.fact_market, risk_staging=src.risk, risk_fact=src.fact_risk
    )
    workloads = workload("Company / month", 2000).unionByName(workload("State / product / month", 2001))
    return _rounded(A.platform_kpis(counts, workloads), 6, "read_reduction")
