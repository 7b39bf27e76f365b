import pytest
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators import quality as Q
from riskmart.operators import warehouse as W
from riskmart.plans import loads as J
from riskmart.plans import refresh as R

from test_loads import manifest, market_rows, write_csv
from test_row_contracts import RISK_GOOD


def test_market_refresh_is_incremental(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path / "wh"), tmp_path / "m.csv"

    def load(rows):
        write_csv(path, C.MARKET_COLUMNS, rows)
        J.load_market(spark, str(path), root, manifest(spark, ("m.csv", len(rows), path.stat().st_size, True)))

    load(market_rows(40))
    warehouse = R.Warehouse(spark, root, C.MARKET)

    # A failure after the fact was written: nothing is published, nothing stays.
    with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="injected"):
        broken.setattr(Q, "run_gate", lambda *a: (_ for _ in ()).throw(RuntimeError("injected")))
        R.refresh_market(spark, root, [str(path)])
    assert warehouse.fact() is None and warehouse.dimension("company") is None
    assert not list((tmp_path / "wh" / "market_fact").glob("refresh_id=*"))

    first = R.refresh_market(spark, root, [str(path)])
    assert first.facts_added == 40 and warehouse.fact().count() == 40
    companies = {r.company_code: r.company_key for r in warehouse.dimension("company").collect()}
    again = R.refresh_market(spark, root, [str(path)])
    assert (again.facts_added, again.members_added) == (0, 0) and warehouse.fact().count() == 40

    # A second version of the file: all its rows are new, old members keep their keys.
    load([[*r[:3], f"new {i}", *r[4:]] for i, r in enumerate(market_rows(25))])
    read, build = [], W.fact_market
    with monkeypatch.context() as watched:
        watched.setattr(W, "fact_market", lambda staging, *rest: (read.extend(r[0] for r in staging.select(F.input_file_name()).distinct().collect()), build(staging, *rest))[1])
        second = R.refresh_market(spark, root, [str(path)])
    newest = warehouse.store.batches().orderBy(F.desc("event_seq")).first().batch_id
    assert read and all(f"batch_id={newest}" in f for f in read)  # the second refresh reads its one new batch
    assert second.facts_added == 25 and second.members_added == 25
    assert {r.company_code: r.company_key for r in warehouse.dimension("company").collect()} == companies
    fact = warehouse.fact()
    assert fact.count() == 65 and fact.select("source_version").distinct().count() == 2
    assert fact.where("record_hash is null or loaded_at is null").count() == 0
    assert warehouse.runs().groupBy("batch_id").count().count() == 2 and warehouse.runs().where("status <> 'SUCCESS'").count() == 0
    stages = {(r.stage, r.status) for r in warehouse.store.read("audit", J.AUDIT_SCHEMA).collect()}
    assert {("WAREHOUSE_REFRESH", "FAILED"), ("WAREHOUSE_REFRESH", "SUCCESS"), ("RECONCILIATION", "SUCCESS"), ("QUALITY_GATE", "SUCCESS")} <= stages
    assert W.market_view(fact, {n: warehouse.dimension(n) for n in W.MARKET_KEYS}).count() == 65


def test_reconciliation_and_guard_stop_a_refresh(spark, tmp_path):
    root, path = str(tmp_path / "wh"), tmp_path / "m.csv"
    write_csv(path, C.MARKET_COLUMNS, market_rows(10))
    J.load_market(spark, str(path), root, manifest(spark, ("m.csv", 10, None, True)))
    store = J.Store(spark, root, C.MARKET)
    batch = store.batches().first().batch_id
    damaged = store.rows("staging").where(F.col("batch_id") == batch).withColumn("premiums", F.col("premiums") + 1)
    store.publish(spark.createDataFrame(damaged.collect(), damaged.schema), "staging", batch)
    with pytest.raises(R.ReconciliationError, match="totals differ"):
        R.refresh_market(spark, root, [str(path)])
    assert R.Warehouse(spark, root, C.MARKET).fact() is None

    other, root = tmp_path / "n.csv", str(tmp_path / "wh2")
    write_csv(other, C.MARKET_COLUMNS, [[r[0], f"{r[1]} {i}", *r[2:]] for i, r in enumerate(market_rows(14))])
    J.load_market(spark, str(other), root, manifest(spark, ("n.csv", 14, None, True)))
    with pytest.raises(W.DimensionError, match="several names"):
        R.refresh_market(spark, root, [str(other)])


def test_risk_refresh(spark, tmp_path):
    root = str(tmp_path / "wh")

    def load(name, *changes):
        path = write_csv(tmp_path / name, C.RISK_COLUMNS, [[{**RISK_GOOD, **c}[k] for k in C.RISK_COLUMNS] for c in changes])
        J.load_risk(spark, [path], root, manifest(spark, (name, len(changes), None, True)))

    load("a.csv", {}, {"VehModel": "other"})
    first = R.refresh_risk(spark, root, manifest(spark, ("a.csv", 2, None, True)))
    assert first.facts_added == 2
    load("b.csv", {"VehModel": "third"})
    both = manifest(spark, ("a.csv", 2, None, True), ("b.csv", 1, None, True))
    second = R.refresh_risk(spark, root, both)
    assert (second.facts_added, second.members_added) == (1, 1)
    warehouse = R.Warehouse(spark, root, C.RISK)
    assert sorted(r.vehicle_key for r in warehouse.dimension("vehicle").collect()) == [0, 1, 2, 3]
    with pytest.raises(Q.QualityGateError, match="STG_PARTITION_RECONCILIATION"):
        R.refresh_risk(spark, root, manifest(spark, ("a.csv", 3, None, True), ("b.csv", 1, None, True)))
    assert warehouse.fact().count() == 3
