"""Every rule of both gates finds something on the damaged layers, and a failed gate raises after one run."""

import pytest

from riskmart.operators import quality as Q
from riskmart.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["dq_risk_damaged", "dq_market_damaged"])
def test_every_rule_observes_damage(spark, name):
    rows = catalog.queries()[name](spark, FOLDER).collect()
    assert len(rows) >= 15 and {r.rule_name: r.observed for r in rows if not r.observed} == {}
    assert {r.status for r in rows if r.severity == "HARD"} == {"FAIL"}


def test_versions_are_no_duplicates(spark):
    queries = catalog.queries()
    for name in ("dq_identity_dup", "dq_fact_grain", "dq_lineage"):
        assert queries[name](spark, FOLDER).first().observed == 0
    assert queries["dq_logical_dup"](spark, FOLDER).first().observed > 0
    added = queries["fact_incremental"](spark, FOLDER)
    assert added.where("source_version = 'V2'").count() > 1000


def test_gate_runs_once_and_logs_what_it_judged(spark, tmp_path):
    check = Q.Check("ALWAYS_ONE", "TEST", "a rule that fails")
    rows = Q.verdicts([Q.observed_rows(spark.sql("select 1 as ALWAYS_ONE"), [check])])
    with pytest.raises(Q.QualityGateError, match="ALWAYS_ONE"):
        Q.run_gate(rows, "test", str(tmp_path / "log"))
    logged = spark.read.parquet(str(tmp_path / "log")).collect()
    assert [(r.rule_name, r.observed, r.status, r.run_label) for r in logged] == [("ALWAYS_ONE", 1, "FAIL", "test")]


def test_layers_compare_in_one_pass(spark):
    schema = "source_file string, source_version string, source_row_number bigint, v string"
    staging = spark.createDataFrame([("a", "1", 1, "x"), ("a", "1", 1, "x"), ("a", "2", 1, "x"), ("a", "1", 2, None), ("a", "1", 3, "x")], schema)
    fact = spark.createDataFrame([("a", "1", 1, "x"), ("a", "2", 1, "y"), ("a", "1", 2, None), ("b", "1", 1, "x"), ("b", "1", 1, "x"), ("b", "1", 1, "x")], schema)
    checks = [Q.Check(n, "T", "") for n in ("i", "c", "g", "l")]
    for mode, want in (("rows", {"i": 1, "c": 1, "g": 2, "l": 2}), ("groups", {"i": 1, "c": 1, "g": 1, "l": 2})):
        got = Q.compared_layers(staging, fact, ("v",), *checks, mode)
        assert {r.rule_name: r.observed for r in got.collect()} == want
    plan = Q.compared_layers(staging, fact, ("v",), *checks, "rows")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
