"""Quality rules, the two gates and reconciliations."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators import quality as Q
from riskmart.plans.contract_queries import CHECKED
from riskmart.plans.fixtures import Sources
from riskmart.plans.registry import query

KNOWN_DUPLICATES = 0
R, M = Q.RISK_CHECKS, Q.MARKET_CHECKS


def rule_sql(check: Q.Check, observed: str) -> str:
    expected = "NULL" if check.expected is None else str(check.expected)
    return (
        f"SELECT '{check.name}' AS rule_name, '{check.domain}' AS domain, '{check.severity}' AS severity, "
        f"CAST(({observed}) AS BIGINT) AS observed, CAST({expected} AS BIGINT) AS expected, '{check.detail}' AS detail"
    )


def _dup_rows(table: str, keys: str) -> str:
    return f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table})) FROM {table}"


def _dup_groups(table: str, keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


def _if(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


_ID = ", ".join(Q.IDENTITY)


def _lineage(fact: str, staging: str, compared: tuple[str, ...]) -> str:
    """Fact identities that staging lacks or holds with other values."""
    value = "CAST([" + ", ".join(f"CAST({c} AS VARCHAR)" for c in compared) + "] AS VARCHAR)"
    return f"""SELECT count(*) FROM (SELECT count_if(layer = 'f') AS f, count_if(layer = 's') AS s, count(DISTINCT v) AS variants FROM (
 SELECT {_ID}, 's' AS layer, {value} AS v FROM {staging} UNION ALL SELECT {_ID}, 'f', {value} FROM {fact}) GROUP BY {_ID}) WHERE f > 0 AND (s = 0 OR variants > 1)"""


_PAIRS = " OR ".join(
    f"(claim_nb_{k} = 0 AND claim_amount_{k} > 0) OR (claim_nb_{k} > 0 AND claim_amount_{k} = 0)"
    for k in ("rob", "partcoll", "totcoll", "fire", "other")
)
_NULLS = " OR ".join(f"{c} IS NULL" for c in Q.MEASURES)
_NEGATIVE = " OR ".join(f"{c} < 0" for c in Q.MEASURES)
_FX_MANIFEST = "(SELECT 'part' || CAST(l_orderkey % 5 AS VARCHAR) || '.csv' AS source_file, count(*) AS expected FROM lineitem GROUP BY 1)"
_RATIO = "(expos_total > 0 AND claim_frequency IS NULL) OR (prem_total > 0 AND loss_ratio IS NULL) OR claim_frequency < 0 OR loss_ratio < 0"

RISK_SQL = {
    "dq_required_null": [rule_sql(list(Q.RISK_ROW_RULES)[0], _if("fx_risk", _NULLS))],
    "dq_nonnegative": [rule_sql(list(Q.RISK_ROW_RULES)[1], _if("fx_risk", _NEGATIVE))],
    "dq_state_pair": [rule_sql(list(Q.RISK_ROW_RULES)[2], _if("fx_risk", "(state IS NULL) <> (state_ab IS NULL)"))],
    "dq_claim_pair": [rule_sql(list(Q.RISK_ROW_RULES)[3], _if("fx_risk", _PAIRS))],
    "dq_ratio_finite": [rule_sql(list(Q.RISK_FACT_RULES)[0], _if("fact_risk", _RATIO))],
    "dq_partition_recon": [rule_sql(R["partition"], f"SELECT count(*) FROM {_FX_MANIFEST} m LEFT JOIN (SELECT source_file, count(*) AS n FROM fx_risk GROUP BY 1) s USING (source_file) WHERE coalesce(n, 0) <> expected")],
    "dq_identity_dup": [rule_sql(R["identity"], _dup_rows("fx_risk", _ID))],
    "dq_state_mapping": [rule_sql(R["mapping"], """SELECT count(*) FROM (SELECT state FROM fx_risk WHERE state IS NOT NULL GROUP BY 1 HAVING count(DISTINCT state_ab) > 1
 UNION ALL SELECT state_ab FROM fx_risk WHERE state_ab IS NOT NULL GROUP BY 1 HAVING count(DISTINCT state) > 1)""")],
    "dq_logical_dup": [rule_sql(R["logical"], _dup_rows("fx_risk", "record_hash"))],
    "dq_fact_staging": [rule_sql(R["counts"], "SELECT abs((SELECT count(*) FROM fx_risk) - (SELECT count(*) FROM fact_risk))")],
    "dq_orphans": [rule_sql(R["orphans"], """SELECT count(*) FROM fact_risk f LEFT JOIN dim_driver d USING (driver_key) LEFT JOIN dim_vehicle v USING (vehicle_key)
 LEFT JOIN dim_geography g USING (geography_key) WHERE d.natural_hash IS NULL OR v.natural_hash IS NULL OR g.natural_hash IS NULL""")],
    "dq_fact_grain": [rule_sql(R["grain"], _dup_rows("fact_risk", _ID))],
    "dq_lineage": [rule_sql(R["lineage"], _lineage("fact_risk", "fx_risk", ("record_hash",)))],
    "dq_dim_unique": [rule_sql(R["dims"], " + ".join(f"({_dup_rows(t, 'natural_hash')})" for t in ("dim_driver", "dim_vehicle", "dim_geography")))],
}
RECON_SQL = """SELECT b.batch_id, b.status AS load_status, b.expected_source_rows, b.accepted_rows, b.rejected_rows,
  coalesce(s.n, 0) AS source_rows, coalesce(s.n, 0) AS staging_rows, coalesce(f.n, 0) AS fact_rows,
  CAST(s.p AS VARCHAR) AS staging_premiums, CAST(f.p AS VARCHAR) AS fact_premiums, CAST(s.c AS VARCHAR) AS staging_claims,
  CAST(f.c AS VARCHAR) AS fact_claims,
  CASE WHEN coalesce(s.n = b.expected_source_rows AND s.n = b.accepted_rows + b.rejected_rows AND s.n = b.accepted_rows
    AND f.n = b.accepted_rows AND s.p = f.p AND s.c = f.c, false) THEN 'SUCCESS' ELSE 'FAILED' END AS status
FROM fx_market_batches b
LEFT JOIN (SELECT batch_id, count(*) AS n, sum(premiums) AS p, sum(claims) AS c FROM fx_market GROUP BY 1) s USING (batch_id)
LEFT JOIN (SELECT batch_id, count(*) AS n, sum(premiums) AS p, sum(claims) AS c FROM fact_market GROUP BY 1) f USING (batch_id)"""
_REFUSED = f"(SELECT batch_id, count(*) AS n FROM ({CHECKED}) WHERE reason IS NOT NULL GROUP BY 1)"
_MARKET_ROWS = [*Q.MARKET_ROW_RULES, *Q.MARKET_WARNINGS]
WARNING_SQL = [
    rule_sql(check, _if("fx_market", condition))
    for check, condition in zip(
        Q.MARKET_WARNINGS,
        ("premiums < 0", "claims < 0", "claim_premium_ratio IS NULL", "claim_premium_ratio < 0"),
        strict=True,
    )
]
MARKET_SQL = {
    "rows": [
        rule_sql(_MARKET_ROWS[0], _if("fx_market", " OR ".join(f"{c} IS NULL" for c in Q.MARKET_REQUIRED))),
        rule_sql(_MARKET_ROWS[1], _if("fx_market", "day(year_month) <> 1")),
        *WARNING_SQL,
    ],
    "dq_batch_recon": [rule_sql(M["batches"], f"""SELECT count(*) FROM fx_market_batches b
 LEFT JOIN (SELECT batch_id, count(*) AS n FROM fx_market GROUP BY 1) s USING (batch_id) LEFT JOIN {_REFUSED} r USING (batch_id)
 WHERE b.status = 'SUCCESS' AND (b.expected_source_rows <> b.accepted_rows + b.rejected_rows OR b.accepted_rows <> coalesce(s.n, 0)
   OR b.rejected_rows <> coalesce(r.n, 0))""")],
    "rejects": [rule_sql(M["rejects"], f"SELECT count(*) FROM ({CHECKED}) WHERE reason IS NOT NULL")],
    "identity": [rule_sql(M["identity"], _dup_groups("fx_market", _ID))],
    "dq_business_grain": [rule_sql(M["grain"], _dup_groups("fx_market", "company_code, year_month, product, state"))],
    "names": [rule_sql(M["names"], "SELECT count(*) FROM (SELECT company_code FROM fx_market GROUP BY 1 HAVING count(DISTINCT company_name) > 1)")],
    "counts": [rule_sql(M["counts"], "SELECT abs((SELECT count(*) FROM fx_market) - (SELECT count(*) FROM fact_market))")],
    "orphans": [rule_sql(M["orphans"], """SELECT count(*) FROM fact_market f LEFT JOIN dim_month m USING (month_key) LEFT JOIN dim_company c USING (company_key)
 LEFT JOIN dim_product p USING (product_key) LEFT JOIN dim_state g USING (state_key)
 WHERE m.natural_hash IS NULL OR c.natural_hash IS NULL OR p.natural_hash IS NULL OR g.natural_hash IS NULL""")],
    "fact_grain": [rule_sql(M["fact_grain"], _dup_groups("fact_market", _ID))],
    "lineage": [rule_sql(M["lineage"], _lineage("fact_market", "fx_market", Q.MARKET_COMPARED))],
    "dims": [rule_sql(M["dims"], " + ".join(f"({_dup_rows(f'dim_{t}', c)})" for t, c in Q.MARKET_NATURAL.items()))],
    "dq_recon_present": [rule_sql(M["recon"], f"""SELECT CASE WHEN EXISTS (SELECT 1 FROM fx_market_batches b WHERE b.status = 'SUCCESS' AND NOT EXISTS (
 SELECT 1 FROM ({RECON_SQL}) r WHERE r.batch_id = b.batch_id AND r.status = 'SUCCESS')) THEN 1 ELSE 0 END""")],
}


def gate_sql(rules: list[str], warnings_pass: bool) -> str:
    status = "CASE WHEN observed = expected THEN 'PASS' ELSE 'FAIL' END"
    if not warnings_pass:
        status = f"CASE WHEN severity = 'WARNING' THEN 'WARNING' ELSE {status} END"
    return f"SELECT *, {status} AS status FROM (" + "\nUNION ALL ".join(rules) + ") ORDER BY domain, rule_name"


def _sql(name: str) -> str:
    return (RISK_SQL.get(name) or MARKET_SQL[name])[0]


def _versions_sql(name: str) -> str:
    return re.sub(r"\b(fx_risk|fact_risk)\b", r"\1_versions", _sql(name))


def _damaged_sql(rules: list[str]) -> list[str]:
    """The same rules on the damaged layers. Batches, rejects and reconciliations are broken as they are."""
    return [re.sub(r"\b(fx_risk|fact_risk|dim_driver|fx_market|fact_market|dim_state)\b", r"\1_damaged", r) for r in rules]


def _columns_sql(off: int) -> str:
    return rule_sql(Q.COLUMNS_CHECK, f"SELECT {off}")


def _manifest(src: Sources) -> DataFrame:
    """Expected rows per file, counted on the source table itself."""
    name = F.concat(F.lit("part"), (F.col("l_orderkey") % 5).cast("string"), F.lit(".csv"))
    return src.read("lineitem").groupBy(name.alias("source_file")).agg(F.count("*").alias("expected_source_rows"))


def _reconciliations(src: Sources) -> DataFrame:
    return Q.reconcile_layers(src.market_batches, src.market, src.market, src.fact_market)


def _row_rule(df: DataFrame, rules: dict, at: int) -> DataFrame:
    check = list(rules)[at]
    return Q.fused_scan(df, {check: rules[check]})


@query("dq_required_null", _sql("dq_required_null"))
def dq_required_null(src: Sources) -> DataFrame:
    return _row_rule(src.risk, Q.RISK_ROW_RULES, 0)


@query("dq_nonnegative", _sql("dq_nonnegative"))
def dq_nonnegative(src: Sources) -> DataFrame:
    return _row_rule(src.risk, Q.RISK_ROW_RULES, 1)


@query("dq_state_pair", _sql("dq_state_pair"))
def dq_state_pair(src: Sources) -> DataFrame:
    return _row_rule(src.risk, Q.RISK_ROW_RULES, 2)


@query("dq_claim_pair", _sql("dq_claim_pair"))
def dq_claim_pair(src: Sources) -> DataFrame:
    return _row_rule(src.risk, Q.RISK_ROW_RULES, 3)


@query("dq_ratio_finite", _sql("dq_ratio_finite"))
def dq_ratio_finite(src: Sources) -> DataFrame:
    return _row_rule(src.fact_risk, Q.RISK_FACT_RULES, 0)


@query("dq_partition_recon", _sql("dq_partition_recon"))
def dq_partition_recon(src: Sources) -> DataFrame:
    return Q.partition_reconciliation(_manifest(src), src.risk, R["partition"])


@query("dq_identity_dup", _versions_sql("dq_identity_dup"))
def dq_identity_dup(src: Sources) -> DataFrame:
    return Q.duplicates(src.risk_versions[0], Q.IDENTITY, R["identity"], mode="rows")


@query("dq_state_mapping", _sql("dq_state_mapping"))
def dq_state_mapping(src: Sources) -> DataFrame:
    return Q.one_to_one(src.risk, "state", "state_ab", R["mapping"])


@query("dq_logical_dup", _versions_sql("dq_logical_dup"))
def dq_logical_dup(src: Sources) -> DataFrame:
    return Q.duplicates(src.risk_versions[0], ("record_hash",), R["logical"], mode="rows")


@query("dq_fact_staging", _sql("dq_fact_staging"))
def dq_fact_staging(src: Sources) -> DataFrame:
    return Q.count_difference(src.risk, src.fact_risk, R["counts"])


@query("dq_orphans", _sql("dq_orphans"))
def dq_orphans(src: Sources) -> DataFrame:
    return Q.orphans(src.fact_risk, src.risk_dims, R["orphans"])


@query("dq_fact_grain", _versions_sql("dq_fact_grain"))
def dq_fact_grain(src: Sources) -> DataFrame:
    return Q.duplicates(src.risk_versions[1], Q.IDENTITY, R["grain"], mode="rows")


@query("dq_lineage", _versions_sql("dq_lineage"))
def dq_lineage(src: Sources) -> DataFrame:
    staging, fact = src.risk_versions
    rules = Q.compared_layers(staging, fact, ("record_hash",), R["identity"], R["counts"], R["grain"], R["lineage"], "rows")
    return rules.where(F.col("rule_name") == R["lineage"].name)


@query("dq_dim_unique", _sql("dq_dim_unique"))
def dq_dim_unique(src: Sources) -> DataFrame:
    return Q.natural_key_duplicates(src.risk_dims, R["dims"])


@query("dq_batch_recon", _sql("dq_batch_recon"))
def dq_batch_recon(src: Sources) -> DataFrame:
    return Q.batch_reconciliation(src.market_batches, src.market, src.market_split[1], M["batches"])


@query("dq_business_grain", _sql("dq_business_grain"))
def dq_business_grain(src: Sources) -> DataFrame:
    return Q.duplicates(src.market, ("company_code", "year_month", "product", "state"), M["grain"])


@query("dq_warnings", "\nUNION ALL ".join(WARNING_SQL))
def dq_warnings(src: Sources) -> DataFrame:
    return Q.fused_scan(src.market, Q.MARKET_WARNINGS)


@query("dq_recon_present", _sql("dq_recon_present"))
def dq_recon_present(src: Sources) -> DataFrame:
    return Q.missing_reconciliation(src.market_batches, _reconciliations(src), M["recon"])


_RISK_RULES = [s for rules in RISK_SQL.values() for s in rules]
_MARKET_RULES = [s for rules in MARKET_SQL.values() for s in rules]
UNDECLARED = "declared_but_absent"


@query("dq_risk", gate_sql([*_RISK_RULES, _columns_sql(0)], True))
def dq_risk(src: Sources) -> DataFrame:
    return Q.risk_gate(src.risk, src.fact_risk, src.risk_dims, _manifest(src), KNOWN_DUPLICATES, layout=src.risk.columns)


@query("dq_risk_damaged", gate_sql([*_damaged_sql(_RISK_RULES), _columns_sql(1)], True))
def dq_risk_damaged(src: Sources) -> DataFrame:
    """The risk gate on damaged layers: every rule finds something."""
    staging, fact, dims = src.risk_damaged
    return Q.risk_gate(staging, fact, dims, _manifest(src), KNOWN_DUPLICATES, layout=[*staging.columns, UNDECLARED])


def _market_gate(src: Sources, inject: bool) -> DataFrame:
    return Q.market_gate(
        src.market, src.market_split[1], src.market_batches, src.fact_market, src.market_dims, _reconciliations(src), inject, src.market.columns
    )


@query("dq_market", gate_sql([*_MARKET_RULES, _columns_sql(0)], False))
def dq_market(src: Sources) -> DataFrame:
    return _market_gate(src, inject=False)


_DAMAGED_MARKET = [
    *(r for name, rules in MARKET_SQL.items() if name not in ("rejects", "dq_recon_present") for r in _damaged_sql(rules)),
    *MARKET_SQL["rejects"], *MARKET_SQL["dq_recon_present"],
]


@query("dq_market_damaged", gate_sql([*(r.replace("fx_market_damaged_batches", "fx_market_batches") for r in _DAMAGED_MARKET), _columns_sql(1)], False))
def dq_market_damaged(src: Sources) -> DataFrame:
    """The market gate on damaged layers: every rule finds something."""
    staging, fact, dims = src.market_damaged
    return Q.market_gate(
        staging, src.market_split[1], src.market_batches, fact, dims, _reconciliations(src), layout=[*staging.columns, UNDECLARED]
    )


@query("dq_inject", gate_sql([*_MARKET_RULES, _columns_sql(0), rule_sql(Q.CONTROLLED_FAILURE, "SELECT 1")], False))
def dq_inject(src: Sources) -> DataFrame:
    """The market gate with its controlled failure row."""
    return _market_gate(src, inject=True)


@query("reconcile_market", RECON_SQL)
def reconcile_market(src: Sources) -> DataFrame:
    totals = ("staging_premiums", "fact_premiums", "staging_claims", "fact_claims")
    return _reconciliations(src).select(
        "batch_id", "load_status", "expected_source_rows", "accepted_rows", "rejected_rows", "source_rows", "staging_rows",
        "fact_rows", *[F.col(c).cast("string").alias(c) for c in totals], "status",
    )


_PRECHECKS = {"loaded": ("fx_risk", "fact_risk"), "damaged": ("fx_risk_damaged", "fact_risk_damaged"), "empty": ("(SELECT * FROM fx_risk LIMIT 0)", "(SELECT * FROM fact_risk LIMIT 0)")}


def _precheck_sql(case: str, staging: str, fact: str) -> str:
    n, m = f"(SELECT count(*) FROM {staging})", f"(SELECT count(*) FROM {fact})"
    return f"SELECT '{case}' AS case_name, {n} AS staging_rows, {m} AS fact_rows, CASE WHEN {n} = {m} AND {n} > 0 THEN 'PASS' ELSE 'FAIL' END AS status"


@query("precheck_risk", " UNION ALL ".join(_precheck_sql(case, *layers) for case, layers in _PRECHECKS.items()))
def precheck_risk(src: Sources) -> DataFrame:
    """The layers as they are, damaged, and empty: only the first may be trained or scored on."""
    layers = {"loaded": (src.risk, src.fact_risk), "damaged": src.risk_damaged[:2], "empty": (src.risk.where("false"), src.fact_risk.where("false"))}
    found = [Q.precheck(*pair).select(F.lit(case).alias("case_name"), "*") for case, pair in layers.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])
