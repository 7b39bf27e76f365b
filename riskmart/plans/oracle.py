"""DuckDB SQL of the derived source tables, shared by all oracle queries."""

from __future__ import annotations

import re

from riskmart.contracts import MARKET_COLUMNS, RISK_COLUMNS, UNKNOWN_LABEL
from riskmart.operators.warehouse import RISK_STAGING_TO_SNAKE
from riskmart.plans.fixtures import RECORD_HASH_COLUMNS

NUL = "chr(0)"


def nul_hash(columns: list[str]) -> str:
    return "upper(sha256(" + f" || {NUL} || ".join(f"coalesce({c}, '<MISSING>')" for c in columns) + "))"


def natural_hash(kind: str, columns: list[str]) -> str:
    pieces = [
        f"CASE WHEN {c} IS NULL THEN 'N;' ELSE 'V' || octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"
        for c in columns
    ]
    return "upper(sha256('" + kind + "|' || " + " || '|' || ".join(pieces) + "))"


def _slots(base: str, changes: dict[int, str]) -> str:
    return "CASE source_row_number % 97 " + " ".join(f"WHEN {k} THEN {v}" for k, v in changes.items()) + f" ELSE {base} END"


def _dim(kind: str, source: str, columns: list[str], hash_columns: list[str] | None = None) -> str:
    name = kind.lower()
    return (
        f"SELECT row_number() OVER (ORDER BY natural_hash) AS {name}_key, * FROM ("
        f"SELECT {natural_hash(kind, hash_columns or columns)} AS natural_hash, {', '.join(columns)} FROM ({source}))"
    )


def _unknown(kind: str, label: dict[str, str]) -> str:
    return f" UNION ALL SELECT 0, repeat('0', 64), {', '.join(label.values())}"


MARKET_HASH = nul_hash([f"CAST({c} AS VARCHAR)" for c in MARKET_COLUMNS])
RISK_HASH = nul_hash([f"CAST({c} AS VARCHAR)" for c in RECORD_HASH_COLUMNS])
CLAIM_COUNT = "(claim_nb_rob + claim_nb_partcoll + claim_nb_totcoll + claim_nb_fire + claim_nb_other)"
CLAIM_AMOUNT = "(claim_amount_rob + claim_amount_partcoll + claim_amount_totcoll + claim_amount_fire + claim_amount_other)"

FX: dict[str, str] = {
    "fx_lineitem": "SELECT *, row_number() OVER () AS ordinal FROM lineitem",
    "fx_market": f"""
SELECT *, {MARKET_HASH} AS record_hash FROM (
SELECT 'market-' || CAST(year(year_month) AS VARCHAR) AS batch_id, 'market.csv' AS source_file, source_version, source_row_number,
  CAST(l_suppkey AS INT) AS company_code, s_name AS company_name, year_month, p_type AS product,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state, premiums, claims,
  CASE WHEN source_row_number % 11 <> 0 THEN
    CAST(CAST(source_row_number % 200 - 3 AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,4)) END AS claim_premium_ratio
FROM (SELECT *, CASE WHEN o % 2 = 1 THEN 'V1' ELSE 'V2' END AS source_version, (o + 1) // 2 AS source_row_number FROM (
  SELECT l.l_suppkey, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS year_month, p.p_type, c.c_nationkey,
    CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))
      * CASE WHEN l.l_linestatus = 'F' AND l.l_linenumber = 7 AND l.l_quantity < 5 THEN -1 ELSE 1 END) AS DECIMAL(38,2)) AS premiums,
    CAST(SUM(CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2))
      ELSE 0 END) AS DECIMAL(38,4)) AS claims,
    MIN(l.ordinal) AS o
  FROM fx_lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY ALL)) JOIN supplier ON s_suppkey = l_suppkey)""",
    "fx_market_raw": f"""
SELECT batch_id, source_file, source_row_number,
  {_slots("CAST(company_code AS VARCHAR)", {1: "''", 2: "'0' || CAST(company_code AS VARCHAR)", 3: "'99999999999'"})} AS company_code,
  {_slots("company_name", {4: "''", 5: "repeat('x', 117)"})} AS company_name,
  {_slots("CAST(year_month AS VARCHAR)", {6: "'2003-02-30'", 7: "substr(CAST(year_month AS VARCHAR), 1, 8) || '15'", 8: "'2003-1-01'"})} AS year_month,
  product, {_slots("state", {9: "'ABC'"})} AS state,
  {_slots("CAST(premiums AS VARCHAR)", {10: "'NaN'", 11: "'abc'", 12: "'1e-5'", 13: "'0.0000000000000000005'", 14: "'0.0000000000000000015'", 15: "'123456789012345678901'"})} AS premiums,
  {_slots("CAST(claims AS VARCHAR)", {16: "'NA'"})} AS claims,
  CASE WHEN source_row_number % 11 = 0 THEN 'NA' WHEN source_row_number % 97 = 17 THEN '' ELSE CAST(claim_premium_ratio AS VARCHAR) END AS claim_premium_ratio
FROM fx_market""",
    "fx_market_batches": """
SELECT batch_id, CASE WHEN y = 1999 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  n + CASE WHEN y % 4 = 0 THEN 1 ELSE 0 END AS expected_source_rows, n - bad AS accepted_rows, bad AS rejected_rows
FROM (SELECT batch_id, CAST(substr(batch_id, 8, 4) AS INT) AS y, count(*) AS n,
  count_if(source_row_number % 97 = 1 AND CAST(substr(batch_id, 8, 4) AS INT) % 2 = 0)::BIGINT AS bad FROM fx_market GROUP BY batch_id)""",
    "dim_month": _dim("Month", "SELECT DISTINCT year_month, year(year_month) AS calendar_year, month(year_month) AS calendar_month FROM fx_market",
                      ["year_month", "calendar_year", "calendar_month"], ["year_month"]),
    "dim_company": _dim("Company", "SELECT company_code, min(company_name) AS company_name FROM fx_market GROUP BY 1",
                        ["company_code", "company_name"], ["company_code"]),
    "dim_product": _dim("Product", "SELECT DISTINCT product FROM fx_market", ["product"]),
    "dim_state": _dim("State", "SELECT DISTINCT state FROM fx_market", ["state"]),
    "fact_market": """
SELECT s.batch_id, s.source_file, s.source_version, s.source_row_number, s.record_hash, m.month_key, c.company_key, p.product_key, g.state_key,
  s.premiums, s.claims, s.claim_premium_ratio, CAST(year(s.year_month) AS INT) AS calendar_year
FROM fx_market s JOIN fx_market_batches b ON b.batch_id = s.batch_id AND b.status = 'SUCCESS'
JOIN dim_month m ON m.year_month = s.year_month JOIN dim_company c ON c.company_code = s.company_code
JOIN dim_product p ON p.product = s.product JOIN dim_state g ON g.state = s.state""",
    "fx_risk": f"""
SELECT {RISK_HASH} AS record_hash, *,
  CAST(expos_total * part_share AS DECIMAL(19,6)) AS expos_fire_rob,
  CAST(prem_total * part_share AS DECIMAL(19,6)) AS prem_fire_rob, CAST(prem_total * 10 AS DECIMAL(19,6)) AS sum_ins_avg
FROM (SELECT 'part' || CAST(l.l_orderkey % 5 AS VARCHAR) || '.csv' AS source_file, 'V1' AS source_version, l.ordinal AS source_row_number,
  NULLIF(c.c_mktsegment, 'FURNITURE') AS gender, NULLIF(o.o_orderpriority, '4-NOT SPECIFIED') AS driv_age,
  CASE WHEN p.p_size = 50 THEN NULL ELSE 1960 + p.p_size END AS veh_year, p.p_name AS veh_model, p.p_brand AS veh_group,
  r.r_name AS area, CASE WHEN n.n_nationkey = 0 THEN NULL ELSE n.n_name END AS state,
  CASE WHEN n.n_nationkey = 0 THEN NULL ELSE lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') END AS state_ab,
  CASE WHEN l.l_quantity = 1 THEN CAST(0 AS DECIMAL(21,4)) ELSE
    CAST(CAST(l.l_quantity AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(21,4)) END AS expos_total,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS prem_total,
  CASE WHEN l.ordinal % 50 = 0 THEN CAST(1.5 AS DECIMAL(2,1)) ELSE CAST(0.5 AS DECIMAL(2,1)) END AS part_share,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_linenumber <= 4 THEN 1 ELSE 0 END AS claim_nb_rob,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_linenumber >= 4 THEN 2 ELSE 0 END AS claim_nb_other,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_linenumber <= 4
    THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(0.10 AS DECIMAL(4,2)) AS DECIMAL(19,6)) ELSE CAST(0 AS DECIMAL(19,6)) END AS claim_amount_rob,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_linenumber >= 4
    THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(19,6)) ELSE CAST(0 AS DECIMAL(19,6)) END AS claim_amount_other,
  0 AS claim_nb_partcoll, 0 AS claim_nb_totcoll, 0 AS claim_nb_fire, CAST(0 AS DECIMAL(19,6)) AS claim_amount_partcoll,
  CAST(0 AS DECIMAL(19,6)) AS claim_amount_totcoll, CAST(0 AS DECIMAL(19,6)) AS claim_amount_fire
FROM fx_lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN part p ON p.p_partkey = l.l_partkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey)""",
    "dim_driver": _dim("Driver", "SELECT DISTINCT gender, driv_age FROM fx_risk", ["gender", "driv_age"])
    + _unknown("Driver", {"gender": "'Unknown / missing'", "driv_age": "'Unknown / missing'"}),
    "dim_vehicle": _dim("Vehicle", "SELECT DISTINCT veh_year, veh_model, veh_group FROM fx_risk", ["veh_year", "veh_model", "veh_group"])
    + _unknown("Vehicle", {"veh_year": "NULL", "veh_model": "'Unknown / not supplied'", "veh_group": "'Unknown / not supplied'"}),
    "dim_geography": _dim("Geography", "SELECT DISTINCT area, state, state_ab FROM fx_risk", ["area", "state", "state_ab"])
    + _unknown("Geography", {"area": "'Unknown / not supplied'", "state": "'Unknown / not supplied'", "state_ab": "NULL"}),
    "fact_risk": f"""
SELECT s.*, d.driver_key, v.vehicle_key, g.geography_key, CAST({CLAIM_COUNT} AS INT) AS total_claim_count,
  {CLAIM_AMOUNT} AS total_claim_amount, CASE WHEN {CLAIM_COUNT} > 0 THEN 1 ELSE 0 END AS has_claim,
  CASE WHEN expos_total > 0 THEN CAST({CLAIM_COUNT} AS DOUBLE) / CAST(expos_total AS DOUBLE) END AS claim_frequency,
  CASE WHEN prem_total > 0 THEN CAST({CLAIM_AMOUNT} AS DOUBLE) / CAST(prem_total AS DOUBLE) END AS loss_ratio
FROM fx_risk s
JOIN dim_driver d ON d.driver_key <> 0 AND d.gender IS NOT DISTINCT FROM s.gender AND d.driv_age IS NOT DISTINCT FROM s.driv_age
JOIN dim_vehicle v ON v.vehicle_key <> 0 AND v.veh_year IS NOT DISTINCT FROM s.veh_year
  AND v.veh_model IS NOT DISTINCT FROM s.veh_model AND v.veh_group IS NOT DISTINCT FROM s.veh_group
JOIN dim_geography g ON g.geography_key <> 0 AND g.area IS NOT DISTINCT FROM s.area
  AND g.state IS NOT DISTINCT FROM s.state AND g.state_ab IS NOT DISTINCT FROM s.state_ab""",
    "fx_scores": """
SELECT source_file, source_version, source_row_number, record_hash, CASE WHEN claim_nb_rob + claim_nb_other > 0 THEN 1 ELSE 0 END AS has_claim,
  CAST(CAST((source_row_number * 7919) % 10001 AS DECIMAL(9,0)) * CAST(0.0001 AS DECIMAL(5,4))
    * CASE WHEN claim_nb_rob + claim_nb_other > 0 THEN CAST(1.0 AS DECIMAL(2,1)) ELSE CAST(0.7 AS DECIMAL(2,1)) END AS DECIMAL(12,10)) AS score
FROM fx_risk""",
    "fx_changes": """
SELECT user_id % 3 AS run_id, event_id AS record_id, event_id // 4 AS lsn, event_id AS seq,
  CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 4 WHEN 'error' THEN 1 ELSE 2 END AS op FROM events""",
    "fx_batch_events": """
SELECT 'batch-' || CAST(user_id AS VARCHAR) AS batch_id, 'file-' || CAST(user_id % 60 AS VARCHAR) AS source_file,
  'v' || CAST(user_id % 120 AS VARCHAR) AS source_version,
  CASE WHEN event_type IN ('signup', 'click') THEN 'RUNNING' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  event_id AS event_seq, event_id % 100 AS accepted_rows, event_id % 7 AS rejected_rows FROM events""",
}


for name in ("fx_risk", "fact_risk"):
    FX[f"{name}_versions"] = f"SELECT * FROM {name} UNION ALL SELECT * REPLACE ('V2' AS source_version) FROM {name} WHERE source_file = 'part4.csv'"
FX |= {
    "fx_risk_damaged": """
SELECT * REPLACE (CASE WHEN source_row_number % 1009 = 1 THEN NULL ELSE prem_total END AS prem_total,
  CASE WHEN source_row_number % 1009 = 2 THEN CAST(-1 AS DECIMAL(19,6)) ELSE claim_amount_rob END AS claim_amount_rob,
  CASE WHEN source_row_number % 1009 = 3 THEN NULL ELSE state END AS state, CASE WHEN source_row_number % 1009 = 4 THEN 'ZZ' ELSE state_ab END AS state_ab,
  CASE WHEN source_row_number % 1009 = 5 THEN 1 ELSE claim_nb_fire END AS claim_nb_fire) FROM fx_risk
UNION ALL SELECT * FROM fx_risk WHERE source_row_number % 1009 = 6""",
    "fact_risk_damaged": """
SELECT * REPLACE (CASE WHEN source_row_number % 1009 = 7 THEN -5 ELSE driver_key END AS driver_key,
  CASE WHEN source_row_number % 1009 = 9 THEN 'X' || record_hash ELSE record_hash END AS record_hash,
  CASE WHEN source_row_number % 1009 = 12 THEN NULL ELSE loss_ratio END AS loss_ratio,
  CASE WHEN source_row_number % 1009 = 10 THEN source_row_number + 1000000000 ELSE source_row_number END AS source_row_number)
FROM fact_risk WHERE source_row_number % 1009 <> 8 UNION ALL SELECT * FROM fact_risk WHERE source_row_number % 1009 = 11""",
    "dim_driver_damaged": "SELECT * FROM dim_driver UNION ALL SELECT * REPLACE (driver_key + 1000000 AS driver_key) FROM dim_driver WHERE driver_key % 3 = 1",
    "fx_market_damaged": """
SELECT * REPLACE (CASE source_row_number % 503 WHEN 1 THEN NULL WHEN 3 THEN 'other name' ELSE company_name END AS company_name,
  CAST(CASE WHEN source_row_number % 503 = 2 THEN year_month + 1 ELSE year_month END AS DATE) AS year_month,
  CASE WHEN source_row_number % 503 = 4 THEN CAST(-1 AS DECIMAL(38,4)) ELSE claims END AS claims) FROM fx_market
UNION ALL SELECT * REPLACE (source_row_number + 1000000000 AS source_row_number) FROM fx_market WHERE source_row_number % 503 = 5
UNION ALL SELECT * FROM fx_market WHERE source_row_number % 503 = 6""",
    "fact_market_damaged": """
SELECT * REPLACE (CASE WHEN source_row_number % 503 = 7 THEN -5 ELSE company_key END AS company_key,
  CASE WHEN source_row_number % 503 = 9 THEN CAST(premiums + 1 AS DECIMAL(38,2)) ELSE premiums END AS premiums,
  CASE WHEN source_row_number % 503 = 10 THEN source_row_number + 1000000000 ELSE source_row_number END AS source_row_number)
FROM fact_market WHERE source_row_number % 503 <> 8 UNION ALL SELECT * FROM fact_market WHERE source_row_number % 503 = 11""",
    "dim_state_damaged": "SELECT * FROM dim_state UNION ALL SELECT * REPLACE (state_key + 1000000 AS state_key) FROM dim_state WHERE state_key % 3 = 1",
}


def _risk_slots(base: str, changes: dict[int, str]) -> str:
    return _slots(base, changes).replace("% 97", "% 211")


_RISK_CHANGES = {
    "Gender": {1: "repeat('x', 21)"},
    "VehYear": {2: "'40000'", 3: "'-1'", 4: "' 1999 '"},
    "ExposTotal": {5: "'0.123456789012345678'", 6: "'12345'", 7: "'-0.5'"},
    "PremTotal": {8: "'1.5e3'", 9: "''", 10: "'Infinity'"},
    "ClaimNbRob": {11: "'2147483648'", 12: "'1.0'"},
    "StateAb": {13: "''"},
}
FX["fx_risk_raw"] = "SELECT source_file, source_row_number, " + ", ".join(
    f"{_risk_slots(text, _RISK_CHANGES[c]) if c in _RISK_CHANGES else text} AS \"{c}\""
    for c, text in ((c, f"coalesce(CAST({RISK_STAGING_TO_SNAKE[c]} AS VARCHAR), '')") for c in RISK_COLUMNS)
) + " FROM fx_risk"


def money(expression: str, places: int = 4) -> str:
    return f"round(CAST({expression} AS DOUBLE), {places})"


FX.update({
    "mart_monthly": f"""
SELECT CAST(m.year_month AS VARCHAR) AS month, g.state, {money('sum(f.premiums)')} AS premium, {money('sum(f.claims)')} AS claims,
  count(*) AS observations
FROM fact_market f JOIN dim_month m USING (month_key) JOIN dim_state g USING (state_key) GROUP BY m.year_month, g.state""",
    "mart_companies": f"""
SELECT f.calendar_year AS year, g.state, f.company_key AS company, {money('sum(f.premiums)')} AS premium, {money('sum(f.claims)')} AS claims
FROM fact_market f JOIN dim_state g USING (state_key) GROUP BY 1, 2, 3""",
    "mart_products": f"""
SELECT f.calendar_year AS year, g.state, f.product_key AS product, {money('sum(f.premiums)')} AS premium, {money('sum(f.claims)')} AS claims
FROM fact_market f JOIN dim_state g USING (state_key) GROUP BY 1, 2, 3""",
    "mart_segments": f"""
SELECT coalesce(state_ab, '{UNKNOWN_LABEL}') AS state, coalesce(gender, '{UNKNOWN_LABEL}') AS gender,
  coalesce(driv_age, '{UNKNOWN_LABEL}') AS age, count(*) AS observations, {money('sum(expos_total)')} AS exposure,
  {money('sum(prem_total)')} AS premium, CAST(sum(total_claim_count) AS BIGINT) AS claim_count,
  {money('sum(total_claim_amount)')} AS claims, CAST(sum(has_claim) AS BIGINT) AS has_claim
FROM fact_risk GROUP BY state_ab, gender, driv_age""",
    "mart_bands": f"""
SELECT coalesce(f.state_ab, '{UNKNOWN_LABEL}') AS state, CAST(floor(CAST(p.score AS DOUBLE) * 20) AS INT) AS band,
  count(*) AS observations, {money('sum(p.score)', 6)} AS score_sum, CAST(sum(f.has_claim) AS BIGINT) AS positives
FROM fx_scores p JOIN fact_risk f USING (source_file, source_version, source_row_number) GROUP BY f.state_ab, 2""",
})
_NAMES = re.compile(r"\b(" + "|".join(sorted(FX, key=len, reverse=True)) + r")\b")


def with_sources(body: str) -> str:
    """Prefix a query with the derived tables it names, in order of need."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(sql)):
            if name not in order:
                visit(FX[name])
                if name not in order:
                    order.append(name)

    visit(body)
    body = body.strip()
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({FX[n].strip()})" for n in order)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
