import pytest
from pyspark.sql import functions as F

from riskmart.functions import formatting as T
from riskmart.functions.measures import ratio
from riskmart.operators import analytics as A

SCHEMA = "month string, state string, premium double, claims double, observations long"


def frames(spark):
    current = spark.createDataFrame([("2023-01-01", "SP", 100.0, 50.0, 20), ("2023-02-01", "SP", 200.0, 100.0, 30)], SCHEMA)
    previous = spark.createDataFrame(
        [("2022-01-01", "SP", 200.0, 40.0, 10), ("2022-02-01", "SP", 200.0, 40.0, 10), ("2022-03-01", "SP", 99999.0, 0.0, 999),
         ("2022-01-01", "RJ", 99999.0, 99999.0, 999)], SCHEMA)
    return current, previous


def test_single_year_comparison_matches_months_and_state(spark):
    current, previous = frames(spark)
    row = A.range_comparison(current, previous, "SP", (2023, 2023)).first()
    assert row.period == "Jan–Feb 2023 vs Jan–Feb 2022"
    assert row.premium_change == pytest.approx(-25) and row.claims_change == pytest.approx(87.5)
    assert row.ratio_change_pp == pytest.approx(30) and row.observations_change == pytest.approx(150)


def test_comparison_is_empty_without_a_baseline(spark):
    current, previous = frames(spark)
    one = previous.where("month = '2022-01-01' AND state = 'SP'")
    assert A.range_comparison(current, one, "SP", (2023, 2023)).count() == 0
    assert A.range_comparison(current.limit(0), previous, "SP", (2023, 2023)).count() == 0


def test_comparison_label_counts_months_when_there_are_gaps(spark):
    data = [(f"{y}-{m:02d}-01", "SP", 10.0 + m, 1.0, 1) for y in (2001, 2003) for m in (1, 3)]
    monthly = spark.createDataFrame(data, SCHEMA)
    assert A.range_comparison(monthly, monthly, "ALL", (2001, 2003)).first().period == "2003 vs 2001 · 2 matched months"


def test_ratio_and_direction(spark):
    df = spark.createDataFrame([(4, 0), (4, -1), (4, 8)], "a int, b int").select(ratio(F.col("a"), F.col("b")).alias("r"))
    assert [r.r for r in df.collect()] == [None, None, 0.5]
    df = spark.createDataFrame([(-0.001,), (1.7,), (-25.0,), (None,)], "c double")
    shown = df.select(T.change_direction(F.col("c")).alias("d"), T.change_text(F.col("c")).alias("t")).collect()
    assert [r.d for r in shown] == ["flat", "up", "down", None]
    assert [r.t for r in shown] == ["0.0%", "+1.7%", "-25.0%", None]


def test_magnitudes(spark):
    values = [None, 0.0, 0.1234, 12.0, 1234.0, 2_500_000.0, 3.05e12, 735.52e9]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(T.format_magnitude(F.col("v")).alias("t"))
    assert [r.t for r in df.collect()] == ["—", "0", "0.123", "12", "1.23K", "2.50M", "3.05T", "735.52B"]


def test_labels(spark):
    names = ["ACME COMPANHIA DE SEGUROS GERAIS S.A. (SP)", "SEGURADORA LIDER DO CONSORCIO DO SEGURO DPVAT S/A", "X E PREVIDÊNCIA - "]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(T.company_short_label(F.col("n")).alias("s"))
    assert [r.s for r in df.collect()] == ["ACME", "LIDER DO CONSORCIO DO…", "X"]
    df = spark.createDataFrame([("0588 - DPVAT",), ("4242 - x",)], "p string").select(T.product_label(F.col("p")).alias("l"))
    labels = [r.l for r in df.select("l", T.product_short_label(F.col("l")).alias("s")).collect()]
    assert labels == ["0588 · DPVAT motor cover", "4242 · Product line 4242"]


def test_bands_are_complete_and_gaps_stay_null(spark):
    bands = spark.createDataFrame([("SP", 0, 4, 0.1, 1), ("SP", 20, 2, 2.0, 2), ("RJ", 10, 1, 0.5, 0)], "state string, band int, observations long, score_sum double, positives long")
    histogram = A.score_histogram(bands).collect()
    assert [r.band for r in histogram] == list(range(20)) and histogram[19].observations == 2
    assert sum(r.observations for r in histogram) == 7
    gaps = [r for r in A.score_calibration(bands).collect() if r.observations == 0]
    assert len(gaps) == 17 and all(r.observed_share is None and r.mean_score is None for r in gaps)
    groups = A.score_groups(bands).first()
    assert (groups.low_observations, groups.high_observations) == (4, 3)


def test_pages_are_clamped_and_shares_use_all_premium(spark):
    data = [(f"2023-{m:02d}-01", s, 1.0 * m, 0.5, 1) for m in range(1, 13) for s in ("SP", "RJ", "AC")]
    monthly = spark.createDataFrame(data, SCHEMA)
    first = A.explorer_page(monthly, "market").collect()
    assert len(first) == 15 and (first[0].month, first[0].state) == ("2023-12-01", "AC")
    last = A.explorer_page(monthly, "market", page=99999).collect()
    assert len(last) == 6 and last[-1].month == "2023-01-01"
    assert A.explorer_page(monthly, "market", "SP", -3).count() == 12
    companies = spark.createDataFrame([(i, float(i)) for i in range(1, 21)], "company long, premium double")
    top = A.top_entities(companies, "company", 10).collect()
    assert [r.company for r in top] == list(range(20, 10, -1))
    assert top[0].share == pytest.approx(100 * 20 / 210)
