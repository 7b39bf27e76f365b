"""Dimensions, facts, the star view and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators import marts as M
from riskmart.operators import warehouse as W
from riskmart.operators.quality import IDENTITY
from riskmart.plans.fixtures import Sources
from riskmart.plans.registry import query

HOT_COMPANY, HOT_STATE, HOT_PRODUCT, HOT_FROM = 72, "07", "STANDARD", 1998


@query("dim_month", "SELECT month_key, natural_hash, CAST(year_month AS VARCHAR) AS year_month, CAST(calendar_year AS INT) AS calendar_year, CAST(calendar_month AS INT) AS calendar_month FROM dim_month")
def dim_month(src: Sources) -> DataFrame:
    return src.market_dims["month"].withColumn("year_month", F.col("year_month").cast("string"))


@query("dim_company", "SELECT * FROM dim_company")
def dim_company(src: Sources) -> DataFrame:
    return src.market_dims["company"]


@query("dim_product", "SELECT * FROM dim_product")
def dim_product(src: Sources) -> DataFrame:
    return src.market_dims["product"]


@query("dim_state", "SELECT * FROM dim_state")
def dim_state(src: Sources) -> DataFrame:
    return src.market_dims["state"]


@query("dim_driver", "SELECT * FROM dim_driver")
def dim_driver(src: Sources) -> DataFrame:
    return src.risk_dims["driver"]


@query("dim_vehicle", "SELECT vehicle_key, natural_hash, CAST(veh_year AS INT) AS veh_year, veh_model, veh_group FROM dim_vehicle")
def dim_vehicle(src: Sources) -> DataFrame:
    return src.risk_dims["vehicle"]


@query("dim_geography", "SELECT * FROM dim_geography")
def dim_geography(src: Sources) -> DataFrame:
    return src.risk_dims["geography"]


@query(
    "dim_surrogate_keys",
    "SELECT natural_hash, row_number() OVER (ORDER BY natural_hash) + 1000 AS company_key FROM dim_company",
)
def dim_surrogate_keys(src: Sources) -> DataFrame:
    """Keys for new members continue after the highest existing key."""
    members = W.market_members(src.market)["company"]
    return W.assign_keys(members, "company_key", last_key=1000).select("natural_hash", "company_key")


@query(
    "dim_incremental",
    """WITH old AS (SELECT row_number() OVER (ORDER BY natural_hash) AS vehicle_key, natural_hash FROM (
  SELECT DISTINCT natural_hash FROM dim_vehicle v WHERE EXISTS (SELECT 1 FROM fx_risk s WHERE s.source_file <> 'part0.csv'
    AND s.veh_year IS NOT DISTINCT FROM v.veh_year AND s.veh_model IS NOT DISTINCT FROM v.veh_model
    AND s.veh_group IS NOT DISTINCT FROM v.veh_group) AND v.vehicle_key <> 0)),
added AS (SELECT (SELECT max(vehicle_key) FROM old) + row_number() OVER (ORDER BY natural_hash) AS vehicle_key, natural_hash
  FROM dim_vehicle WHERE vehicle_key <> 0 AND natural_hash NOT IN (SELECT natural_hash FROM old))
SELECT * FROM old UNION ALL SELECT * FROM added""",
)
def dim_incremental(src: Sources) -> DataFrame:
    """The vehicle dimension after four files, extended by the fifth."""
    kind, attributes = W.VEHICLE
    first_load = W.members(src.risk.where(F.col("source_file") != "part0.csv"), kind, attributes)
    existing = W.assign_keys(first_load, "vehicle_key")
    everything = W.members(src.risk, kind, attributes)
    return W.extend_dimension(existing, everything, "vehicle_key").select("vehicle_key", "natural_hash")


@query(
    "fd_company_name",
    """WITH pairs AS (SELECT DISTINCT veh_model, veh_group FROM fx_risk),
clash AS (SELECT veh_model, count(*) AS names FROM pairs GROUP BY 1 HAVING count(*) > 1)
SELECT 'company' AS rule, CAST(company_code AS VARCHAR) AS code, company_name AS name, names FROM
  (SELECT company_code, company_name, count(*) OVER (PARTITION BY company_code) AS names FROM
    (SELECT DISTINCT company_code, company_name FROM fx_market)) WHERE names > 1
UNION ALL SELECT 'vehicle', veh_model, veh_group, names FROM pairs JOIN clash USING (veh_model)""",
)
def fd_company_name(src: Sources) -> DataFrame:
    """Codes with several names: none for companies, some for vehicle models."""
    companies = W.name_conflicts(src.market).select(
        F.lit("company").alias("rule"), F.col("company_code").cast("string").alias("code"), F.col("company_name").alias("name"), "names"
    )
    vehicles = W.name_conflicts(src.risk, "veh_model", "veh_group").select(
        F.lit("vehicle").alias("rule"), F.col("veh_model").alias("code"), F.col("veh_group").alias("name"), "names"
    )
    return companies.unionByName(vehicles)


FACT_MARKET_SQL = """SELECT batch_id, source_file, source_version, source_row_number, record_hash, month_key, company_key, product_key, state_key,
  CAST(premiums AS VARCHAR) AS premiums, CAST(claims AS VARCHAR) AS claims, CAST(claim_premium_ratio AS VARCHAR) AS claim_premium_ratio,
  calendar_year FROM fact_market"""


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


@query("fact_market", FACT_MARKET_SQL)
def fact_market(src: Sources) -> DataFrame:
    return _as_text(src.fact_market, "premiums", "claims", "claim_premium_ratio")


_FIRST_VERSION = "SELECT * FROM fact_market WHERE source_version = 'V1'"


@query(
    "fact_incremental",
    f"""SELECT s.source_file, s.source_version, s.source_row_number, s.batch_id FROM fx_market s WHERE NOT EXISTS (SELECT 1 FROM ({_FIRST_VERSION}) f
  WHERE f.source_file = s.source_file AND f.source_version = s.source_version AND f.source_row_number = s.source_row_number)""",
)
def fact_incremental(src: Sources) -> DataFrame:
    """Rows to add to a fact that holds the file's first version: all of the second, and those of the failed batch."""
    loaded = src.fact_market.where("source_version = 'V1'")
    return W.missing_facts(src.market, loaded, IDENTITY).select(*IDENTITY, "batch_id")


@query(
    "fact_risk",
    """SELECT source_file, source_row_number, record_hash, driver_key, vehicle_key, geography_key, total_claim_count,
  CAST(total_claim_amount AS DOUBLE) AS total_claim_amount, has_claim, round(claim_frequency, 4) AS claim_frequency, round(loss_ratio, 4) AS loss_ratio
FROM fact_risk""",
)
def fact_risk(src: Sources) -> DataFrame:
    return src.fact_risk.select(
        "source_file",
        "source_row_number",
        "record_hash",
        "driver_key",
        "vehicle_key",
        "geography_key",
        "total_claim_count",
        F.col("total_claim_amount").cast("double").alias("total_claim_amount"),
        "has_claim",
        F.round(F.col("claim_frequency").cast("double"), 4).alias("claim_frequency"),
        F.round(F.col("loss_ratio").cast("double"), 4).alias("loss_ratio"),
    )


@query(
    "risk_derived",
    """SELECT source_file, count(*) AS rows, CAST(sum(claim_nb_rob + claim_nb_other) AS BIGINT) AS claim_count,
  round(CAST(sum(claim_amount_rob + claim_amount_other) AS DOUBLE), 4) AS claim_amount,
  count_if(claim_nb_rob + claim_nb_other > 0)::BIGINT AS with_claim, count_if(expos_total <= 0)::BIGINT AS no_frequency,
  count_if(prem_total <= 0)::BIGINT AS no_loss_ratio,
  round(avg(CASE WHEN expos_total > 0 THEN CAST(claim_nb_rob + claim_nb_other AS DOUBLE) / CAST(expos_total AS DOUBLE) END), 4) AS mean_frequency
FROM fx_risk GROUP BY source_file""",
)
def risk_derived(src: Sources) -> DataFrame:
    return W.with_claim_measures(src.risk).groupBy("source_file").agg(
        F.count("*").alias("rows"),
        F.sum("total_claim_count").alias("claim_count"),
        F.round(F.sum("total_claim_amount").cast("double"), 4).alias("claim_amount"),
        F.count_if(F.col("has_claim") == 1).alias("with_claim"),
        F.count_if(F.col("claim_frequency").isNull()).alias("no_frequency"),
        F.count_if(F.col("loss_ratio").isNull()).alias("no_loss_ratio"),
        F.round(F.avg("claim_frequency").cast("double"), 4).alias("mean_frequency"),
    )


@query(
    "market_view",
    """SELECT CAST(m.year_month AS VARCHAR) AS year_month, m.calendar_year::INT AS calendar_year, m.calendar_month::INT AS calendar_month,
  c.company_code, c.company_name, p.product, g.state, CAST(f.premiums AS VARCHAR) AS premiums, CAST(f.claims AS VARCHAR) AS claims,
  CAST(f.claim_premium_ratio AS VARCHAR) AS source_claim_premium_ratio,
  CASE WHEN f.premiums <> 0 THEN round(CAST(f.claims AS DOUBLE) / CAST(f.premiums AS DOUBLE), 6) END AS row_claim_premium_ratio,
  f.source_file, f.source_row_number
FROM fact_market f JOIN dim_month m USING (month_key) JOIN dim_company c USING (company_key)
JOIN dim_product p USING (product_key) JOIN dim_state g USING (state_key)""",
)
def market_view(src: Sources) -> DataFrame:
    view = W.market_view(src.fact_market, src.market_dims)
    view = view.withColumn("row_claim_premium_ratio", F.round("row_claim_premium_ratio", 6))
    return _as_text(view, "year_month", "premiums", "claims", "source_claim_premium_ratio")


@query(
    "layer_counts",
    """SELECT (SELECT count(*) FROM fx_market) AS market_staging, (SELECT count(*) FROM fact_market) AS market_fact,
  (SELECT count(*) FROM fx_risk) AS risk_staging, (SELECT count(*) FROM fact_risk) AS risk_fact""",
)
def layer_counts(src: Sources) -> DataFrame:
    return M.layer_counts(
        market_staging=src.market, market_fact=src.fact_market, risk_staging=src.risk, risk_fact=src.fact_risk
    )


@query("mart_monthly", "SELECT * FROM mart_monthly ORDER BY month, state")
def mart_monthly(src: Sources) -> DataFrame:
    return M.monthly(src.fact_market, src.market_dims)


@query("mart_companies", "SELECT * FROM mart_companies")
def mart_companies(src: Sources) -> DataFrame:
    return M.by_year(src.fact_market, src.market_dims, "company")


@query("mart_products", "SELECT * FROM mart_products")
def mart_products(src: Sources) -> DataFrame:
    return M.by_year(src.fact_market, src.market_dims, "product")


@query("mart_risk_segments", "SELECT * FROM mart_segments")
def mart_risk_segments(src: Sources) -> DataFrame:
    return M.risk_segments(src.fact_risk, src.risk_dims)


@query("score_bands", "SELECT * FROM mart_bands")
def score_bands(src: Sources) -> DataFrame:
    return M.score_bands(src.scores, src.fact_risk, src.risk_dims)


@query(
    "lookup_names",
    """SELECT 'company' AS kind, company_key AS key, company_name AS name FROM dim_company
UNION ALL SELECT 'product', product_key, product FROM dim_product""",
)
def lookup_names(src: Sources) -> DataFrame:
    return M.lookup_names(src.market_dims)


@query(
    "perf_company_month",
    f"""SELECT c.company_code, CAST(m.year_month AS VARCHAR) AS month, round(CAST(sum(f.premiums) AS DOUBLE), 4) AS premium,
  round(CAST(sum(f.claims) AS DOUBLE), 4) AS claims
FROM fact_market f JOIN dim_company c USING (company_key) JOIN dim_month m USING (month_key)
WHERE c.company_code = {HOT_COMPANY} AND m.calendar_year >= {HOT_FROM} GROUP BY c.company_code, m.year_month ORDER BY 2""",
)
def perf_company_month(src: Sources) -> DataFrame:
    return M.company_by_month(src.fact_by_company, src.market_dims, HOT_COMPANY, HOT_FROM)


@query(
    "perf_state_product_month",
    f"""SELECT g.state, p.product, CAST(m.year_month AS VARCHAR) AS month, round(CAST(sum(f.premiums) AS DOUBLE), 4) AS premium,
  round(CAST(sum(f.claims) AS DOUBLE), 4) AS claims
FROM fact_market f JOIN dim_state g USING (state_key) JOIN dim_product p USING (product_key) JOIN dim_month m USING (month_key)
WHERE g.state = '{HOT_STATE}' AND p.product = '{HOT_PRODUCT}' AND m.calendar_year >= {HOT_FROM}
GROUP BY g.state, p.product, m.year_month ORDER BY 3""",
)
def perf_state_product_month(src: Sources) -> DataFrame:
    return M.state_product_by_month(src.fact_by_state_product, src.market_dims, HOT_STATE, HOT_PRODUCT, HOT_FROM)


def _mart_recon_sql(case: str, table: str, fact: str, lost: str = "FALSE") -> str:
    total = f"(SELECT coalesce(sum(observations), 0) FROM {table} WHERE NOT ({lost}))"
    return f"""SELECT '{case}' AS mart, 'observations' AS measure, CAST({total} AS BIGINT) AS mart_observations, (SELECT count(*) FROM {fact}) AS fact_rows,
  CASE WHEN {total} = (SELECT count(*) FROM {fact}) THEN 'SUCCESS' ELSE 'FAILED' END AS status"""


@query("mart_recon", " UNION ALL ".join([
    _mart_recon_sql("monthly", "mart_monthly", "fact_market"), _mart_recon_sql("risk", "mart_segments", "fact_risk"),
    _mart_recon_sql("risk without a state", "mart_segments", "fact_risk", "state = (SELECT min(state) FROM mart_segments)"),
]))
def mart_recon(src: Sources) -> DataFrame:
    """Both marts against their facts, and the risk mart after a state was lost."""
    risk = M.risk_segments(src.fact_risk, src.risk_dims)
    first = risk.agg(F.min("state").alias("state"))
    cases = [("monthly", M.monthly(src.fact_market, src.market_dims), src.fact_market), ("risk", risk, src.fact_risk)]
    cases.append(("risk without a state", risk.where(F.col("state") != first.scalar()), src.fact_risk))
    found = [M.reconciliation(mart, fact).select(F.lit(name).alias("mart"), "*") for name, mart, fact in cases]
    return found[0].unionByName(found[1]).unionByName(found[2])
