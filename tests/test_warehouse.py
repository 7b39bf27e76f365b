import pytest

from riskmart.functions.hashing import ZERO_HASH
from riskmart.operators import quality as Q
from riskmart.operators import warehouse as W

from conftest import rows

SCHEMA = "source_file string, source_row_number long, gender string, driv_age string"


def test_dimension_grows_without_moving_keys(spark):
    first = spark.createDataFrame([("a", 1, "M", None), ("a", 2, "M", None), ("a", 3, None, None)], SCHEMA)
    kind, attributes = W.DRIVER
    dim = W.assign_keys(W.members(first, kind, attributes), "driver_key")
    assert dim.count() == 2
    more = first.union(spark.createDataFrame([("a", 4, "F", "18-25"), ("a", 5, "M", None)], SCHEMA))
    grown = W.extend_dimension(dim, W.members(more, kind, attributes), "driver_key")
    old, new = rows(dim, "natural_hash", "driver_key"), rows(grown, "natural_hash", "driver_key")
    assert set(old) < set(new) and sorted(k for _, k in new) == [1, 2, 3]
    again = W.extend_dimension(grown, W.members(more, kind, attributes), "driver_key")
    assert rows(again, "natural_hash", "driver_key") == new


def test_natural_hash_tells_null_from_text_and_boundaries(spark):
    df = spark.createDataFrame([("x", 1, None, "a"), ("x", 2, "N;", "a"), ("x", 3, "", "a"), ("x", 4, "a|", "b"), ("x", 5, "a", "|b")], SCHEMA)
    assert W.members(df, *W.DRIVER).select("natural_hash").distinct().count() == 5


def test_unknown_member_is_reserved(spark):
    staging = spark.createDataFrame([("a", 1, None, None)], SCHEMA)
    dim = W.risk_dimension(staging, W.DRIVER)
    unknown = dim.where("driver_key = 0").first()
    assert unknown.natural_hash == ZERO_HASH and unknown.gender == "Unknown / missing"
    assert dim.where("driver_key = 1").first().gender is None


def test_second_fact_load_adds_nothing(spark):
    staging = spark.createDataFrame([("a", i, "M", None) for i in range(5)], SCHEMA)
    identity = ("source_file", "source_row_number")
    assert W.missing_facts(staging, staging.limit(0), identity).count() == 5
    assert W.missing_facts(staging, staging, identity).count() == 0


def test_company_names_must_be_unique(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B"), (2, "C")], "company_code int, company_name string")
    assert rows(W.name_conflicts(df)) == [(2, "B", 2), (2, "C", 2)]
    with pytest.raises(W.DimensionError):
        W.require_one_name(df)


def test_gate_passes_fails_and_logs(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    check = Q.Check("X_NULL", "STAGING", "x is required")
    log = str(tmp_path / "log")
    good = Q.verdicts([Q.fused_scan(df, {check: "x < 0"})])
    assert [r.status for r in Q.run_gate(good, "test", log)] == ["PASS"]
    with pytest.raises(Q.QualityGateError, match="X_NULL"):
        Q.run_gate(Q.verdicts([Q.fused_scan(df, {check: "x IS NULL"})]), "test", log)
    with pytest.raises(Q.QualityGateError, match="CONTROLLED"):
        Q.run_gate(Q.verdicts([Q.fused_scan(df, {check: "x < 0"})], inject_failure=True), "test", log)
    assert spark.read.parquet(log).count() == 4
    unknown = Q.observed_rows(spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS X_NULL"), [check])
    with pytest.raises(Q.QualityGateError):
        Q.run_gate(Q.verdicts([unknown]), "test")


def test_row_and_group_duplicates_differ(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",)], "k string")
    check = Q.Check("D", "STAGING", "unique")
    assert Q.duplicates(df, ("k",), check, "rows").first().observed == 5
    assert Q.duplicates(df, ("k",), check, "groups").first().observed == 2


def test_reconciliation_success_and_failure(spark):
    batches = spark.createDataFrame([("b", "SUCCESS", 2, 2, 0)], "batch_id string, status string, expected_source_rows long, accepted_rows long, rejected_rows long")
    layer = spark.createDataFrame([("b", 1), ("b", 2)], "batch_id string, v int").selectExpr("batch_id", "CAST(v AS DECIMAL(38,18)) AS premiums", "CAST(v AS DECIMAL(38,18)) AS claims")
    assert Q.reconcile_layers(batches, layer, layer, layer).first().status == "SUCCESS"
    # The last decimal place counts: 3 against 3.000000000000000001.
    off = layer.selectExpr("batch_id", "CASE WHEN premiums = 1 THEN CAST('1.000000000000000001' AS DECIMAL(38,18)) ELSE premiums END AS premiums", "claims")
    assert Q.reconcile_layers(batches, layer, off, layer).first().status == "FAILED"
    assert Q.reconcile_layers(batches, layer, layer, layer.limit(1)).first().status == "FAILED"
