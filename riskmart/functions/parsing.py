"""Lexical parsers: text column in, typed column (or digit counts) out.

A NULL result means the text breaks the rule. All expressions are built-ins,
so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANONICAL_INT = r"^(0|-?[1-9][0-9]*)\z"
MONTH_START = r"^[0-9]{4}-[0-9]{2}-01\z"
DECIMAL_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,9})?\z"
EDGE_SPACE = r"^\s+|\s+\z"
TIDY = r"^\s+|\s+\z|_"
INTEGER_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*\z"
NONNEGATIVE_TEXT = r"^\s*([+]?[0-9]+(_[0-9]+)*|-0+(_0+)*)\s*\z"


def canonical_int(text: Column) -> Column:
    """int32 whose text is exactly what printing the number would give."""
    return F.when(text.rlike(CANONICAL_INT), text.try_cast("int"))


def month_start(text: Column) -> Column:
    """Date from strict ``YYYY-MM-01`` text."""
    day = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(text.rlike(MONTH_START) & (F.year(day) >= 1), day)


def iso_date(text: Column) -> Column:
    day = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & (F.year(day) >= 1), day)


def loose_int(text: Column) -> Column:
    """Integer in Python's lexical form (spaces, sign, leading zeros, ``_`` groups)."""
    return F.when(text.rlike(INTEGER_TEXT), F.regexp_replace(text, r"[\s_]", "").try_cast("decimal(38,0)"))


def nonneg_int(text: Column, kind: str = "int") -> Column:
    """Non-negative integer of a Spark type (``int`` or ``smallint``), as int."""
    plain = F.when(text.rlike(r"^[0-9]+\z"), text).when(text.rlike(NONNEGATIVE_TEXT), F.regexp_replace(text, r"[\s_]", ""))
    return plain.try_cast(kind).cast("int")


def with_plain_decimals(df: DataFrame, texts: Mapping[str, str]) -> DataFrame:
    """Adds plain-notation copies of decimal texts: ``{new column: text column}``.

    NULL marks text that is no finite decimal literal. An exponent is written
    out and the scale is kept, but never more zeros than any declared decimal
    holds. The pieces are built in separate projections, so that each is
    evaluated once per row and generated code stays small.
    """
    kept = df.columns
    df = df.withColumns({f"_tidy_{o}": F.regexp_replace(F.col(i), TIDY, "") for o, i in texts.items()})
    # Only exponents need the pieces below; elsewhere they stay NULL and cost nothing.
    df = df.withColumns({
        f"_digits_{o}": F.when(
            F.col(f"_tidy_{o}").rlike("[eE]"),
            F.regexp_replace(F.regexp_extract(f"_tidy_{o}", "^[+-]?([0-9.]*)", 1), "[.]", ""),
        )
        for o in texts
    })
    df = df.withColumns({
        f"_scale_{o}": F.when(
            F.col(f"_digits_{o}").isNotNull(),
            F.greatest(
                F.least(
                    F.length(F.regexp_extract(f"_tidy_{o}", "[.]([0-9]*)", 1))
                    - F.substring_index(F.lower(f"_tidy_{o}"), "e", -1).try_cast("int"),
                    F.length(f"_digits_{o}") + 40,
                ),
                F.lit(-64),
            ),
        )
        for o in texts
    })
    df = df.withColumns({
        f"_padded_{o}": F.when(
            F.col(f"_scale_{o}") > 0,
            F.lpad(f"_digits_{o}", F.greatest(F.length(f"_digits_{o}"), F.col(f"_scale_{o}") + 1), "0"),
        ).otherwise(F.concat(f"_digits_{o}", F.repeat(F.lit("0"), -F.col(f"_scale_{o}"))))
        for o in texts
    })

    def spelled(o: str) -> Column:
        padded, places = F.col(f"_padded_{o}"), F.greatest(f"_scale_{o}", F.lit(0))
        return F.concat(
            F.regexp_extract(f"_tidy_{o}", "^([+-]?)", 1),
            F.substring(padded, F.lit(1), F.length(padded) - places),
            F.lit("."),
            F.substring(padded, F.length(padded) - places + 1, places),
        )

    return df.select(
        *[c for c in kept if c not in texts],
        *[
            F.when(
                F.col(f"_tidy_{o}").rlike(DECIMAL_TEXT),
                F.when(F.col(f"_digits_{o}").isNotNull(), spelled(o)).otherwise(F.col(f"_tidy_{o}")),
            ).alias(o)
            for o in texts
        ],
    )


def with_decimal_parts(df: DataFrame, text: str) -> DataFrame:
    """Adds ``negative``, ``digits`` and ``scale`` of a decimal text: the value is digits / 10^scale, whatever its size.

    NULL digits mark text that is no finite decimal literal. ``digits`` has no
    leading zeros and is ``0`` for a zero; the exponent is in ``scale``.
    """
    tidy, kept = F.regexp_replace(F.col(text), TIDY, ""), df.columns
    df = df.withColumn("_tidy", F.when(tidy.rlike(DECIMAL_TEXT), F.lower(tidy)))
    df = df.withColumns({"_mantissa": F.substring_index("_tidy", "e", 1), "_power": F.when(F.col("_tidy").contains("e"), F.substring_index("_tidy", "e", -1).cast("int")).otherwise(0)})
    return df.select(
        *kept, F.col("_tidy").startswith("-").alias("negative"),
        F.regexp_replace(F.regexp_replace("_mantissa", "[+.-]", ""), "^0+(?=[0-9])", "").alias("digits"),
        (F.length(F.regexp_extract("_mantissa", "[.]([0-9]*)", 1)) - F.col("_power")).alias("scale"),
    )


def half_even_decimal(plain: Column, places: int = 18, integer_limit: int = 20) -> Column:
    """decimal(38,18) of a plain literal, rounded half to even; NULL if too large.

    Spark's cast rounds half up, so only an exact tie on an even digit needs
    care: there the text is cut instead of rounded.
    """
    tie = rf"^([+-]?[0-9]*[.][0-9]{{{places - 1}}}[02468])50*\z"
    return F.regexp_replace(plain, tie, "$1").try_cast(f"decimal({integer_limit + places},{places})")


def decimal_literal(text: Column) -> Column:
    """The text without outer spaces and ``_`` if it is a finite decimal literal."""
    clean = F.regexp_replace(text, TIDY, "")
    return F.when(text.rlike(DECIMAL_TEXT), text).when(clean.rlike(DECIMAL_TEXT), clean)


def written_scale(literal: Column) -> Column:
    """Fraction digits of a literal, moved by its exponent if it has one."""
    power = F.when(literal.rlike("[eE]"), F.substring_index(F.lower(literal), "e", -1).try_cast("int")).otherwise(0)
    return F.greatest(F.length(F.regexp_extract(literal, "[.]([0-9]*)", 1)) - power, F.lit(0))


def exact_decimal(literal: Column, precision: int, scale: int) -> Column:
    """Non-negative decimal that fits (precision, scale) with nothing rounded away.

    Plain digits, the usual case, take one pattern; signs and exponents take the
    longer way.
    """
    usual = literal.rlike(rf"^[0-9]{{1,{precision - scale}}}([.][0-9]{{0,{scale}}})?\z")
    unusual = (written_scale(literal) <= scale) & ~literal.rlike(r"^-[0.]*[1-9]")
    return F.when(F.when(usual, True).otherwise(unusual), literal.try_cast(f"decimal({precision},{scale})"))


def exact_decimal_text(literal: Column, value: Column) -> Column:
    """Plain notation of a fitting literal, with the scale it was written in."""
    shape = F.concat(F.lit("^-?[0-9]+[.][0-9]{"), written_scale(literal).cast("string"), F.lit("}"))
    unfolded = F.regexp_substr(value.cast("string"), shape)
    text = F.when(literal.rlike("[eE]"), unfolded).otherwise(literal)
    text = F.regexp_replace(text, r"^[+]|[.]\z", "")
    text = F.regexp_replace(text, r"^(-?)0+(?=[0-9])", "$1")
    text = F.regexp_replace(text, r"^(-?)(?=[.])", "$10")
    return F.when(literal.rlike(r"^(0|[1-9][0-9]*)([.][0-9]+)?\z"), literal).otherwise(text)
