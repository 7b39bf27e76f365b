import csv
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators import batches as B
from riskmart.operators import quality as Q
from riskmart.operators import warehouse as W
from riskmart.operators.row_contracts import SourceContractError, apply_market_contract
from riskmart.plans import loads as J
from riskmart.plans import snapshot as X
from riskmart.sources import csv_contract as S
from riskmart.sources.tables import scan_with_ordinals, shared_folder

from test_row_contracts import GOOD, RISK_GOOD


def write_csv(path, header, data, bom=True):
    with path.open("w", encoding="utf-8-sig" if bom else "utf-8", newline="") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(data)
    return str(path)


def market_rows(n, **changes):
    return [[{**GOOD, "company_code": str(i % 7 + 1), "company_name": f"C{i % 7 + 1}", "state": "SP",
              "year_month": f"20{i % 20:02d}-0{i % 9 + 1}-01", "product": f"{i:04d} - X", **changes}[c] for c in C.MARKET_COLUMNS] for i in range(n)]


def manifest(spark, *entries):
    return spark.createDataFrame(list(entries), J.MANIFEST_SCHEMA)


def test_row_numbers_over_many_splits(spark, tmp_path):
    data = [[str(i), *r[1:]] for i, r in enumerate(market_rows(4000))]
    paths = [write_csv(tmp_path / f"{n}.csv", C.MARKET_COLUMNS, data) for n in ("a", "b")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        landed = S.land_with_row_numbers(spark, paths, C.MARKET)
        assert landed.where("source_row_number <> CAST(company_code AS BIGINT) + 1").count() == 0
        assert landed.groupBy("source_file").agg(F.max("source_row_number").alias("m")).select("m").distinct().first().m == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_header_must_match(spark, tmp_path):
    good = write_csv(tmp_path / "good.csv", C.MARKET_COLUMNS, market_rows(1))
    S.check_header(spark, [good], C.MARKET)
    bad = write_csv(tmp_path / "bad.csv", C.MARKET_COLUMNS[::-1], market_rows(1))
    (tmp_path / "empty.csv").write_bytes(b"")
    quoted = tmp_path / "quoted.csv"
    quoted.write_text(",".join(f'"{c}"' for c in C.MARKET_COLUMNS) + "\n")
    S.check_header(spark, [good, str(quoted)], C.MARKET)
    for paths in ([bad], [good, bad], [str(tmp_path / "empty.csv"), good]):
        with pytest.raises(SourceContractError):
            S.check_header(spark, paths, C.MARKET)


def test_row_width_and_quotes(spark, tmp_path):
    data = market_rows(4)
    data[1].append("extra")
    data[2] = data[2][:5]
    data[3][1] = 'A, "B"'
    path = write_csv(tmp_path / "w.csv", C.MARKET_COLUMNS, data)
    landed = {r.source_row_number: r for r in S.land_with_row_numbers(spark, [path], C.MARKET).collect()}
    assert [landed[i].cells for i in (1, 2, 3, 4)] == [8, 9, 5, 8]
    assert landed[2].extra_cells and not landed[3].extra_cells
    assert landed[4].company_name == 'A, "B"'


def version_of(data: bytes, fold: int) -> str:
    level = [hashlib.sha256(line).hexdigest() for line in data.split(b"\n")[: None if data and not data.endswith(b"\n") else -1]]
    while len(level) > 1:
        blocks = [level[i : i + fold] for i in range(0, len(level), fold)]
        level = [b[0] if len(b) == 1 else hashlib.sha256("".join(b).encode()).hexdigest() for b in blocks]
    return hashlib.sha256(f"{len(data)}:{''.join(level)}".encode()).hexdigest().upper()


def test_versions_by_one_definition(spark, tmp_path, monkeypatch):
    contents = {"one": b"x", "unix": b"x\ny\n", "windows": b"x\r\ny", "open": b"x\ny", "long": b"".join(b"row %d\r\n" % i for i in range(300)), "bytes": b"\xff\xfe\nab"}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    paths = [str(tmp_path / name) for name in contents]
    for fold, split in ((1024, "128m"), (7, "128m"), (7, "200")):  # small and large files take the same way
        monkeypatch.setattr(S, "FOLD", fold)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            got = {r.source_file: (r.source_version, r.length) for r in S.fingerprints(spark, paths).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == {name: (version_of(data, fold), len(data)) for name, data in contents.items()}
    assert len({v for v, _ in got.values()}) == len(contents)


def test_row_numbers_do_not_move_rows(spark, tmp_path):
    paths = [write_csv(tmp_path / f"{n}.csv", C.MARKET_COLUMNS, market_rows(20)) for n in ("a", "b", "c")]
    plan = S.land_with_row_numbers(spark, paths, C.MARKET)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    spark.range(0, 50, 1, 3).write.parquet(str(tmp_path / "p"))
    numbered = scan_with_ordinals(spark, str(tmp_path / "p"))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert sorted(r.ordinal for r in numbered.collect()) == list(range(1, 51))


def test_rejects_keep_the_whole_line(spark, tmp_path):
    data = market_rows(3)
    data[0] += ["nine", "t,en"]
    data[1] = data[1][:6]
    path = write_csv(tmp_path / "m.csv", C.MARKET_COLUMNS, data)
    checked = {r.source_row_number: r for r in apply_market_contract(S.land_with_row_numbers(spark, [path], C.MARKET)).collect()}
    wide, short = json.loads(checked[1].raw_payload), json.loads(checked[2].raw_payload)
    assert wide["raw_line"].endswith(',nine,"t,en"') and wide["company_code"] == data[0][0]
    assert short["claims"] is None and short["claim_premium_ratio"] is None and short["premiums"] == data[1][5]
    assert checked[3].raw_payload is None


def test_market_load_publish_skip_and_retry(spark, tmp_path):
    data = market_rows(50)
    data[3][5] = "NaN"
    data[9].append("x")
    path = write_csv(tmp_path / "m.csv", C.MARKET_COLUMNS, data)
    size, root = (tmp_path / "m.csv").stat().st_size, str(tmp_path / "wh")
    store = J.Store(spark, root, C.MARKET)
    with pytest.raises(SourceContractError, match="manifest expects 51"):
        J.load_market(spark, path, root, manifest(spark, ("m.csv", 51, size, True)))
    assert store.published().count() == 0 and store.batches().first().status == "FAILED"
    good = manifest(spark, ("m.csv", 50, size, True))
    result = J.load_market(spark, path, root, good)
    assert (result.outcome, result.source_rows, result.accepted_rows, result.rejected_rows) == ("SUCCESS", 50, 48, 2)
    assert not [p for p in os.listdir(shared_folder(spark)) if p.startswith(("riskmart-load-", "riskmart-version-"))]
    assert store.rows("staging").count() == 48
    reasons = {r.source_row_number: r.reject_reason for r in store.published("rejects").collect()}
    assert reasons == {4: "row 4: premiums is not a finite decimal", 10: "row 10: row has more cells than the contract"}
    again = J.load_market(spark, path, root, good)
    assert again.outcome == "SKIPPED" and again.batch_id == result.batch_id
    assert store.published().count() == 48
    assert store.read("audit", J.AUDIT_SCHEMA).where("status = 'SKIPPED'").count() == 1
    with pytest.raises(SourceContractError, match="bytes"):
        J.load_market(spark, path, root, manifest(spark, ("m.csv", 50, size + 1, True)))

    staging = store.published()
    assert Q.required_columns(staging, C.MARKET_STAGING_COLUMNS, Q.COLUMNS_CHECK).first().observed == 0
    assert Q.required_columns(staging.drop("state"), C.MARKET_STAGING_COLUMNS, Q.COLUMNS_CHECK).first().observed == 1
    assert B.successful(store.batches()) == 1
    with pytest.raises(RuntimeError, match="at least 5"):
        B.successful(store.batches(), 5)
    dims = W.market_dimensions(staging)
    fact = W.fact_market(staging, dims, store.batches())
    assert fact.count() == 48
    c = Q.MARKET_CHECKS
    layers = Q.compared_layers(staging, fact, Q.MARKET_COMPARED, c["identity"], c["counts"], c["fact_grain"], c["lineage"], "groups")
    gate = Q.verdicts([layers, Q.orphans(fact, dims, c["orphans"]), Q.fused_scan(staging, Q.MARKET_ROW_RULES)])
    assert {r.status for r in Q.run_gate(gate, "load test")} == {"PASS"}


def test_risk_load_is_all_or_nothing(spark, tmp_path):
    def write(name, *changes):
        return write_csv(tmp_path / name, C.RISK_COLUMNS, [[{**RISK_GOOD, **c}[k] for k in C.RISK_COLUMNS] for c in changes])

    root = str(tmp_path / "wh")
    good, bad = write("a.csv", {}, {"PremTotal": "12.50"}), write("b.csv", {}, {"ClaimNbRob": "-1"})
    listed = manifest(spark, ("a.csv", 2, None, True), ("b.csv", 2, None, True))
    assert J.load_risk(spark, [good], root, listed)[0].outcome == "SUCCESS"
    with pytest.raises(SourceContractError, match="ClaimNbRob"):
        J.load_risk(spark, [bad], root, listed)
    store = J.Store(spark, root, C.RISK)
    assert store.published().select("source_file").distinct().count() == 1
    assert store.rows("staging").count() == 2
    assert Q.required_columns(store.published(), C.RISK_STAGING_COLUMNS, Q.COLUMNS_CHECK).first().observed == 0
    assert J.load_risk(spark, [good], root, listed)[0].outcome == "SKIPPED"
    with pytest.raises(SourceContractError, match="manifest"):
        J.load_risk(spark, [write("z.csv", {})], root, listed)


def test_snapshot_round_trip(spark, tmp_path):
    root = str(tmp_path / "snap")
    monthly = spark.createDataFrame([("2023-01-01", "SP", 1.0, 2.0, 3)], "month string, state string, premium double, claims double, observations long")
    X.write_snapshot(root, {"monthly": monthly})
    X.write_snapshot(root, {"monthly": monthly.withColumn("premium", F.lit(9.0))})
    tables = X.read_snapshot(spark, root)
    assert tables["monthly"].first().premium == 9.0
    X.check_snapshot(tables, {"monthly": X.LAYOUTS["monthly"]})
    with pytest.raises(X.SnapshotError):
        X.check_snapshot(tables, X.LAYOUTS)
    X.export_market_csv(tables["monthly"], str(tmp_path / "csv"), "SP")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == [*X.LAYOUTS["monthly"], "year"]
    X.write_snapshot(root, {"monthly": monthly}, version=2)
    with pytest.raises(X.SnapshotError):
        X.read_snapshot(spark, root)
