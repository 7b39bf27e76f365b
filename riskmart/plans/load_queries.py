"""Load history and count checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators import batches as B
from riskmart.plans.contract_queries import CHECKED
from riskmart.plans.fixtures import Sources
from riskmart.plans.registry import query

LATEST = """SELECT batch_id, event_seq, source_file, source_version, status, accepted_rows, rejected_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY event_seq DESC) AS r FROM fx_batch_events) WHERE r = 1"""
_STORED = "SELECT batch_id, max(accepted_rows) AS sa, max(rejected_rows) AS sr FROM fx_batch_events GROUP BY 1"


@query("batch_latest_state", LATEST)
def batch_latest_state(src: Sources) -> DataFrame:
    return B.latest_state(src.batch_events)


def _plan_sql(policy: str, key: str) -> str:
    by_content = policy == "content"
    return f"""SELECT '{policy}' AS policy, i.source_file, i.source_version, CASE WHEN newest IS NULL THEN CASE WHEN coalesce(open, 0) > 0 THEN 'RETRY' ELSE 'LOAD' END
  WHEN {"newest % 2 = 1" if by_content else "true"} THEN 'SKIP' ELSE 'BROKEN' END AS action FROM incoming i LEFT JOIN (
  SELECT {key}, max(CASE WHEN status = 'SUCCESS' THEN event_seq * 2 + CASE WHEN accepted_rows = coalesce(sa, 0) AND rejected_rows = coalesce(sr, 0) THEN 1 ELSE 0 END END) AS newest,
    count_if(status <> 'SUCCESS') AS open FROM latest LEFT JOIN stored USING (batch_id) GROUP BY {key}) USING ({key})"""


@query(
    "load_plan",
    f"""WITH latest AS ({LATEST}), stored AS ({_STORED}), incoming AS (
  SELECT DISTINCT 'file-' || CAST(o_custkey % 80 AS VARCHAR) AS source_file, 'v' || CAST(o_custkey % 240 AS VARCHAR) AS source_version FROM orders)
{_plan_sql('content', 'source_file, source_version')} UNION ALL {_plan_sql('name', 'source_file')}""",
)
def load_plan(src: Sources) -> DataFrame:
    """Sources named by orders, planned against the load history under both policies."""
    customer = F.col("o_custkey")
    incoming = src.read("orders").select(
        F.concat(F.lit("file-"), (customer % 80).cast("string")).alias("source_file"),
        F.concat(F.lit("v"), (customer % 240).cast("string")).alias("source_version"),
    ).distinct()
    batches = B.latest_state(src.batch_events)
    stored = src.batch_events.groupBy("batch_id").agg(
        F.max("accepted_rows").alias("stored_accepted"), F.max("rejected_rows").alias("stored_rejected")
    )
    plans = [
        B.load_plan(incoming, batches, stored, by_content=policy == "content").withColumn("policy", F.lit(policy))
        for policy in ("content", "name")
    ]
    return plans[0].unionByName(plans[1])


@query(
    "load_reconciliation",
    f"""SELECT b.batch_id, b.expected_source_rows, coalesce(n, 0) AS source_rows, coalesce(a, 0)::BIGINT AS accepted, coalesce(r, 0)::BIGINT AS rejected,
  CASE WHEN coalesce(n, 0) = expected_source_rows AND n = a + r THEN 'SUCCESS' ELSE 'FAILED' END AS status
FROM fx_market_batches b LEFT JOIN (SELECT batch_id, count(*) AS n, count_if(reason IS NULL) AS a, count_if(reason IS NOT NULL) AS r FROM ({CHECKED}) GROUP BY 1) USING (batch_id)""",
)
def load_reconciliation(src: Sources) -> DataFrame:
    return B.load_reconciliation(src.market_checked, src.market_batches)


@query(
    "status_counts",
    """SELECT 'market_staging' AS table_name, count(*) AS rows FROM fx_market UNION ALL SELECT 'market_fact', count(*) FROM fact_market
UNION ALL SELECT 'risk_staging', count(*) FROM fx_risk UNION ALL SELECT 'risk_fact', count(*) FROM fact_risk UNION ALL SELECT 'predictions', count(*) FROM fx_scores""",
)
def status_counts(src: Sources) -> DataFrame:
    return B.table_counts(
        market_staging=src.market,
        market_fact=src.fact_market,
        risk_staging=src.risk,
        risk_fact=src.fact_risk,
        predictions=src.scores,
    )
