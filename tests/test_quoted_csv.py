import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators.row_contracts import SourceContractError
from riskmart.plans import loads as J
from riskmart.sources import csv_contract as S

from test_loads import manifest
from test_row_contracts import RISK_GOOD

WIDTH = len(C.MARKET_COLUMNS)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "200b")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def content(seed, rows=120, end="\n"):
    """Rows with line ends, commas and doubled quotes inside quoted fields, quotes inside plain ones, empty lines, rows of other widths."""
    draw = random.Random(seed)
    fields = ["1", "", "plain", 'in"side', '"a,b"', '"line\nend"', '"two\n\nends"', '"say ""x"""', '"""\n"""', '"\r\n"', '"x, ""y"",\nz"', " sp ", "ü"]
    out = [",".join(C.MARKET_COLUMNS)]
    for k in range(rows):
        width = WIDTH if draw.random() < 0.9 else draw.choice([WIDTH - 1, WIDTH + 1])
        out.append(",".join([f"r{k}", *(draw.choice(fields) for _ in range(width - 1))]))
        if draw.random() < 0.1:
            out.append("")
    return end.join(out) + end


def serial(text):
    return [row for row in csv.reader(io.StringIO(text, newline="")) if row][1:]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_reader_equals_a_serial_parser(spark, tmp_path, small_splits, end):
    texts = {f"f{seed}.csv": content(seed, end=end) for seed in range(2)}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    paths = [str(tmp_path / name) for name in texts]
    assert S._lines(spark, paths).select(F.spark_partition_id()).distinct().count() > 20
    rows = S.land_with_row_numbers(spark, paths, C.MARKET, str(tmp_path / "landing")).collect()
    for name, text in texts.items():
        want = serial(text)
        got = {r.source_row_number: r for r in rows if r.source_file == name}
        assert sorted(got) == list(range(1, len(want) + 1))
        for number, row in enumerate(want, 1):
            assert got[number].cells == len(row) and got[number].extra_cells == (len(row) > WIDTH)
            if len(row) == WIDTH:
                assert [got[number][c] or "" for c in C.MARKET_COLUMNS] == row and got[number].raw_line is None
            else:
                assert next(csv.reader(io.StringIO(got[number].raw_line, newline=""))) == row


def test_a_file_without_such_fields_is_read_as_before(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text(",".join(C.MARKET_COLUMNS) + '\n"a,b",x,"say ""hi""",,,,,\n1,2,in"side,4,5,6,7,8\n')
    rows = S.land_with_row_numbers(spark, [str(path)], C.MARKET, str(tmp_path / "landing"))
    assert "starts" in [p.name for p in (tmp_path / "landing").iterdir()] and not (tmp_path / "landing" / "flagged").exists()
    assert [tuple(r) for r in rows.orderBy("source_row_number").select("company_code", "year_month").collect()] == [("a,b", 'say "hi"'), ("1", 'in"side')]


def test_a_quote_that_never_closes_stops_the_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "FIELD_LIMIT", 100)
    path = tmp_path / "open.csv"
    path.write_text(",".join(C.MARKET_COLUMNS) + '\n1,"open' + "\nline" * 400 + "\n")
    with pytest.raises(SourceContractError, match="row 1 has a quoted field that is not closed"):
        S.land_with_row_numbers(spark, [str(path)], C.MARKET, str(tmp_path / "landing"))


def test_both_loads_take_line_ends_in_quotes(spark, tmp_path, small_splits):
    good = ["1", 'Com"pany', "2020-01-01", "product", "SP", "10", "5", "0.5"]
    path = tmp_path / "m.csv"
    with path.open("w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle, lineterminator="\n")
        writer.writerows([C.MARKET_COLUMNS, *([str(i), f"two\nlines {i}", *good[2:]] for i in range(30)), ["31", "bad\nprice", *good[2:5], "x", "5", "0.5"]])
    done = J.load_market(spark, str(path), str(tmp_path / "wh"), manifest(spark, ("m.csv", 31, None, True)))
    assert (done.source_rows, done.accepted_rows, done.rejected_rows) == (31, 30, 1)
    store = J.Store(spark, str(tmp_path / "wh"), C.MARKET)
    assert {r.company_name for r in store.published().collect()} == {f"two\nlines {i}" for i in range(30)}
    assert [r.source_row_number for r in store.published("rejects").collect()] == [31]
    path = tmp_path / "r.csv"
    rows = [[RISK_GOOD[c] for c in C.RISK_COLUMNS] for _ in range(20)]
    for row in rows[::2]:
        row[C.RISK_COLUMNS.index("VehModel")] = "model\nof two lines"
    with path.open("w", newline="", encoding="utf-8") as handle:
        csv.writer(handle).writerows([C.RISK_COLUMNS, *rows])
    [done] = J.load_risk(spark, [str(path)], str(tmp_path / "wr"), manifest(spark, ("r.csv", 20, None, True)))
    assert done.accepted_rows == 20
