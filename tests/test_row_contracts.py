from riskmart import contracts as C
from riskmart.operators import row_contracts as R

import pytest

GOOD = {
    "company_code": "72", "company_name": "Acme", "year_month": "2003-01-01", "product": "0588 - X", "state": "SP",
    "premiums": "-1.5", "claims": "1e-5", "claim_premium_ratio": "NA",
}
BROKEN = [
    ({"company_code": ""}, "company_code is required"),
    ({"company_code": "072"}, "company_code is not a canonical integer"),
    ({"company_code": "2147483648"}, "company_code is outside int32"),
    ({"company_name": ""}, "company_name is required"),
    ({"company_name": "x" * 117}, "company_name is longer than 116 characters"),
    ({"year_month": "2003-02-30"}, "year_month is not an ISO date"),
    ({"year_month": "2003-02-15"}, "year_month is not the first day of a month"),
    ({"state": "ABC"}, "state is longer than 2 characters"),
    ({"premiums": "NaN"}, "premiums is not a finite decimal"),
    ({"premiums": "NA"}, "premiums is not a finite decimal"),
    ({"premiums": "123456789012345678901"}, "premiums does not fit the declared decimal"),
    ({"claim_premium_ratio": ""}, "claim_premium_ratio is required"),
    ({"company_code": "x", "state": ""}, "company_code is not a canonical integer"),
]


def market(spark, changes):
    data = [(i + 1, *[{**GOOD, **c}[k] for k in C.MARKET_COLUMNS]) for i, c in enumerate(changes)]
    return spark.createDataFrame(data, "source_row_number long, " + ", ".join(f"{c} string" for c in C.MARKET_COLUMNS))


def test_market_rows_are_split_with_the_first_reason(spark):
    changes = [{}, *[c for c, _ in BROKEN]]
    checked = R.apply_market_contract(market(spark, changes)).orderBy("source_row_number").collect()
    assert checked[0].reject_reason is None and checked[0].raw_payload is None
    assert checked[0].claim_premium_ratio is None and checked[0].claim_premium_ratio_raw is None
    assert str(checked[0].claims) == "0.000010000000000000"
    for row, (_, reason) in zip(checked[1:], BROKEN, strict=True):
        assert row.reject_reason == f"row {row.source_row_number}: {reason}"
        assert row.raw_payload.startswith('{"company_code":')
    assert sum(r.reject_reason is None for r in checked) + len(BROKEN) == len(changes)


RISK_GOOD = {
    **{c: "" for c in C.RISK_TEXT_LIMITS}, "VehYear": "", **{c: "0" for c in C.RISK_DECIMALS}, **{c: "0" for c in C.RISK_COUNTS},
}
RISK_BROKEN = [
    ({"Gender": "x" * 21}, "Gender is longer than 20 characters"),
    ({"VehYear": "40000"}, "VehYear is not a non-negative 16-bit integer"),
    ({"ExposTotal": "0.123456789012345678"}, "ExposTotal does not fit the declared decimal"),
    ({"ExposTotal": "-1"}, "ExposTotal does not fit the declared decimal"),
    ({"PremFireRob": ""}, "PremFireRob is required"),
    ({"SumInsAvg": "Infinity"}, "SumInsAvg is not a finite decimal"),
    ({"ClaimNbFire": "1.0"}, "ClaimNbFire is not a non-negative 32-bit integer"),
    ({"State": "Acre"}, "State and StateAb must be null together"),
]


def risk(spark, changes):
    data = [("a.csv", i + 1, *[{**RISK_GOOD, **c}[k] for k in C.RISK_COLUMNS]) for i, c in enumerate(changes)]
    return spark.createDataFrame(data, "source_file string, source_row_number long, " + ", ".join(f"{c} string" for c in C.RISK_COLUMNS))


def test_risk_rows_and_fail_fast(spark):
    good = R.apply_risk_contract(risk(spark, [{}, {"PremTotal": "1.5e3", "VehYear": " 1999 "}]))
    R.require_clean(good)
    second = good.where("source_row_number = 2").first()
    assert second.PremTotal == 1500 and second.VehYear == 1999 and second.State is None
    bad = R.apply_risk_contract(risk(spark, [c for c, _ in RISK_BROKEN]))
    for row, (_, reason) in zip(bad.orderBy("source_row_number").collect(), RISK_BROKEN, strict=True):
        assert row.reject_reason == f"row {row.source_row_number}: {reason}"
    with pytest.raises(R.SourceContractError, match="8 bad rows; first: row 1: Gender"):
        R.require_clean(bad)
