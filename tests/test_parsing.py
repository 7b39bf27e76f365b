import random
from decimal import ROUND_HALF_EVEN, Decimal, InvalidOperation, localcontext

from pyspark.sql import functions as F

from riskmart.functions import hashing as H
from riskmart.functions import parsing as P

EDGES = [
    "", ".", "+", "-", "1", "1.", ".5", "-.5", "+7", " 7 ", "1_000", "007", "-0", "-0.0", "NaN", "Infinity", "1e5", "1E-5",
    "1e-19", "5e-19", "15e-19", "25e-19", "5.00000000001e-19", "-5e-19", "-15e-19", "0.10", "1.50e1", "\t3\n", "1 2", "1e",
    "99999999999999999999.9999999999999999995", "99999999999999999999", "100000000000000000000", "1e-999999999",
    "1e999999999", "0.0000000000000000005", "0.0000000000000000015", "000000000000000000000000000001", "1e19", "1e20", "abc",
    "123456789012345678901", "0000", "0.000", "1.5e3", "150e-1", "10e2", "12\n", "0x1", "--1", "1.2.3",
]


def texts():
    rng = random.Random(5)
    out = list(EDGES)
    for _ in range(1500):
        whole = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 1, 2, 5, 19, 20, 21])))
        part = "".join(rng.choice("05") if rng.random() < 0.5 else rng.choice("0123456789") for _ in range(rng.choice([0, 1, 17, 18, 19, 20, 25])))
        if rng.random() < 0.5 and len(part) >= 18:
            part = part[:18] + "5" + "0" * rng.choice([0, 1, 3])
        text = rng.choice(["", "-", "+"]) + whole + ("." + part if part or rng.random() < 0.1 else "")
        if rng.random() < 0.3:
            text += rng.choice("eE") + rng.choice(["", "-", "+"]) + str(rng.randint(0, 25))
        out.append(text)
    return out


def finite(text):
    try:
        value = Decimal(text)
    except InvalidOperation:
        return None
    return value if value.is_finite() else None


def half_even(text):
    value = finite(text)
    if value is None:
        return None
    try:
        with localcontext() as context:
            context.prec = 60
            rounded = value.quantize(Decimal("1e-18"), rounding=ROUND_HALF_EVEN)
    except InvalidOperation:
        return None
    return None if rounded.adjusted() > 19 else rounded


def exact(text, precision, scale):
    value = finite(text)
    if value is None or value < 0:
        return None
    fraction = max(0, -value.as_tuple().exponent)
    whole = 0 if value.is_zero() else max(0, value.adjusted() + 1)
    return value if fraction <= scale and whole <= precision - scale else None


def as_int(text):
    try:
        return int(text)
    except ValueError:
        return None


def test_decimals_and_integers_match_python(spark):
    source = spark.createDataFrame([(t,) for t in texts()], "t string")
    df = P.with_plain_decimals(source, {"plain": "t"})
    literal = P.decimal_literal(F.col("t"))
    fitted = P.exact_decimal(literal, 21, 17)
    df = df.select(
        "t",
        P.half_even_decimal(F.col("plain")).alias("rounded"),
        fitted.alias("fitted"),
        P.exact_decimal_text(literal, fitted).alias("spelled"),
        P.loose_int(F.col("t")).alias("whole"),
        P.canonical_int(F.col("t")).alias("code"),
        P.nonneg_int(F.col("t")).alias("nonneg"),
    )
    for r in df.collect():
        assert r.rounded == half_even(r.t), r
        wanted = exact(r.t, 21, 17)
        assert r.fitted == wanted, r
        if wanted is not None:
            assert r.spelled in (format(wanted, "f"), format(abs(wanted), "f")), r
        number = as_int(r.t)
        assert (None if r.whole is None else int(r.whole)) == number, r
        inside = number is not None and -(2**31) <= number < 2**31
        assert r.code == (number if inside and str(number) == r.t else None), r
        assert r.nonneg == (number if inside and number >= 0 else None), r


def test_month_start(spark):
    good = ["2003-01-01", "2024-12-01", "0001-01-01"]
    bad = ["2003-1-01", "2003-01-15", "2003-13-01", "0000-01-01", "2003-02-30", "", "2003-01-01\n", " 2003-01-01"]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string").select("t", P.month_start(F.col("t")).cast("string").alias("d"))
    assert {r.t: r.d for r in df.collect()} == {**{t: t for t in good}, **{t: None for t in bad}}


def test_record_hashes_match_python(spark):
    import hashlib
    import json

    df = spark.createDataFrame([("a", None, "ü"), ('q"\\', "", "x")], "a string, b string, c string")
    hashed = df.select("*", H.text_record_hash([F.col(c) for c in "abc"]).alias("h"))
    for r in hashed.collect():
        text = "\0".join("<MISSING>" if v is None else v for v in (r.a, r.b, r.c))
        assert r.h == hashlib.sha256(text.encode()).hexdigest().upper()
    typed = df.select("*", H.typed_record_hash([(c, "text", F.col(c)) for c in "abc"]).alias("h"))
    for r in typed.collect():
        text = json.dumps([[c, r[c]] for c in "abc"], ensure_ascii=False, separators=(",", ":"))
        assert r.h == hashlib.sha256(text.encode()).hexdigest().upper()
