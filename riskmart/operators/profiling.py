"""Column profiles: text, decimals, dates, quantiles, duplicates, precision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.contracts import NULL_SENTINELS
from riskmart.functions import parsing as P
from riskmart.operators.ranks import slice_by_bounds
from riskmart.sources.tables import work_folder, write_table

QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
TOP = 10
SLICES = 64


def stack_columns(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """(column_name, value) pairs of several columns."""
    pairs = ", ".join(f"'{c}', cast(`{c}` AS {kind})" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, value)")


def _trimmed(column: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), P.EDGE_SPACE, "")


def top_values(df: DataFrame, columns: Sequence[str], limit: int = TOP) -> DataFrame:
    """Most frequent values per column; ties go to the smaller value.

    Values are counted before they are ranked, and the rank filter lets Spark
    cut each partition to ``limit`` rows per column before the shuffle.
    """
    counts = stack_columns(df, columns).where("value IS NOT NULL AND value <> ''").groupBy("column_name", "value").agg(
        F.count("*").alias("count")
    )
    order = Window.partitionBy("column_name").orderBy(F.desc("count"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def text_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, cardinality and longest value per text column."""
    trimmed = df.select(*[_trimmed(c).alias(c) for c in columns])
    counts = stack_columns(trimmed, columns).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value") == "", F.col("n"))), F.lit(0)).alias("null_count"),
        F.count_if(F.col("value") != "").alias("cardinality"),
        F.max(F.length("value")).alias("max_length"),
    )


LIMB = 18
# Powers of ten a profile writes out; a value beyond them is shown in powers of ten, and its column has no sum.
WRITTEN_POWERS = 100_000


def _plain(negative: bool, digits: str, scale: int) -> str:
    """Shortest plain notation of digits / 10^scale."""
    digits = digits.lstrip("0") or "0"
    cut = len(digits) - len(digits.rstrip("0")) if digits != "0" else 0
    digits, scale = digits[: len(digits) - cut], (scale - cut) if digits != "0" else 0
    sign = "-" if negative and digits != "0" else ""
    if abs(scale) > WRITTEN_POWERS:
        return f"{sign}{digits}E{-scale}"
    if scale <= 0:
        return sign + digits + "0" * -scale
    padded = digits.rjust(scale + 1, "0")
    return f"{sign}{padded[:-scale]}.{padded[-scale:]}"


def _numeric_facts(pieces: DataFrame, columns: Sequence[str]) -> tuple[list, list]:
    """The summary of each column, and the totals of its limbs."""
    facts, limbs = [], []
    for i, c in enumerate(columns):
        n, blank = F.col(f"n{i}"), F.col(f"b{i}")
        positive, below = ~n["zero"] & ~n["negative"], ~n["zero"] & n["negative"]
        facts.append(F.struct(
            F.lit(c).alias("column_name"), F.count(n).alias("present_count"), F.count_if(blank).alias("null_count"),
            F.count_if(~blank & n.isNull()).alias("invalid_count"), F.count_if(below).alias("negative_count"), F.count_if(n["zero"]).alias("zero_count"),
            F.max(F.when(positive, n["size"])).alias("high"), F.min(F.when(positive, n["size"])).alias("low"),
            F.max(F.when(below, n["size"])).alias("deep"), F.min(F.when(below, n["size"])).alias("near"),
            F.coalesce(F.max(F.greatest(F.length(n["digits"]) - n["scale"], F.lit(0))), F.lit(0)).alias("max_integer_digits"),
            F.coalesce(F.max(F.greatest(n["scale"], F.lit(0))), F.lit(0)).alias("max_scale_digits"),
            F.coalesce(F.max(F.abs(n["scale"])), F.lit(0)).alias("power"),
        ))
        limbs.append(F.struct(F.lit(i).alias("i"), n.alias("n")))
    # A row is 18 digits of a value at a fixed place; most values have one or two.
    low = F.floor(-F.col("n.scale") / F.lit(LIMB)).cast("int")
    shifted = F.concat("n.digits", F.repeat(F.lit("0"), -F.col("n.scale") - low * LIMB))
    filled = F.lpad(shifted, (F.ceil(F.length(shifted) / LIMB) * LIMB).cast("int"), "0")
    placed = pieces.select(F.inline(F.array(*limbs))).where(f"n is not null and not n.zero and abs(n.scale) <= {WRITTEN_POWERS}").select(
        "i", F.when(F.col("n.negative"), -1).otherwise(1).alias("sign"), low.alias("low"), filled.alias("filled")
    )
    at = F.col("at") + F.col("low")
    chunk = F.substring(F.col("filled"), F.length("filled") - (F.col("at") + 1) * LIMB + 1, F.lit(LIMB))
    parts = placed.select("i", "sign", "low", "filled", F.explode(F.sequence(F.lit(0), (F.length("filled") / LIMB).cast("int") - 1)).alias("at"))
    sums = parts.groupBy("i", at.alias("limb")).agg(F.sum(F.col("sign") * chunk.cast("decimal(18,0)")).alias("total"))
    return pieces.agg(F.array(*facts).alias("r")).first().r, sums.collect()


def numeric_text_profile(df: DataFrame, sentinels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Lexical profile of decimal text columns, with a suggested decimal type.

    ``sentinels`` names the columns and, in upper case, their spellings of null.
    Values of any size are exact: they are compared by the place of their first
    digit and then by their digits, and summed in limbs of 18 digits. The one
    summary row and the few limbs of a column are put together on the driver.
    """
    columns = list(sentinels)
    pieces = df.select(*[_trimmed(c).alias(f"v{i}") for i, c in enumerate(columns)])
    for i, c in enumerate(columns):
        blank = F.upper(f"v{i}").isin(*sentinels[c])
        rest = [x for x in pieces.columns if x != f"v{i}"]
        parsed = P.with_decimal_parts(pieces.withColumn("_blank", blank), f"v{i}")
        zero, weight = F.col("digits") == "0", F.length("digits") - F.col("scale")
        size = F.struct(weight.alias("weight"), F.rtrim(F.col("digits"), F.lit("0")).alias("digits"))
        value = F.when(~F.col("_blank") & F.col("digits").isNotNull(), F.struct("negative", zero.alias("zero"), "digits", "scale", size.alias("size")))
        pieces = parsed.select(*rest, value.alias(f"n{i}"), F.col("_blank").alias(f"b{i}"))
    # Parsed once and written: both passes below would parse each value anew for every figure they take from it.
    with work_folder(df.sparkSession, "numeric-profile") as folder:
        facts, limbs = _numeric_facts(write_table(pieces, folder), columns)
    rows = []
    for i, (c, r) in enumerate(zip(columns, facts, strict=True)):
        own = [(x.limb, int(x.total)) for x in limbs if x.i == i]
        base = min([limb for limb, _ in own], default=0)
        total = sum(t * 10 ** (LIMB * (limb - base)) for limb, t in own)
        zero = "0" if r.zero_count else None
        shown = lambda negative, size: size and _plain(negative, size.digits, len(size.digits) - size.weight)
        precision = min(max(r.max_integer_digits + r.max_scale_digits, 1), 38)
        rows.append((
            c, r.present_count, r.null_count, r.invalid_count, r.negative_count, r.zero_count, shown(True, r.deep) or zero or shown(False, r.low),
            shown(False, r.high) or zero or shown(True, r.near), _plain(total < 0, str(abs(total)), -LIMB * base) if r.present_count and r.power <= WRITTEN_POWERS else None,
            r.max_integer_digits, r.max_scale_digits, f"DECIMAL({precision},{r.max_scale_digits})",
        ))
    return df.sparkSession.createDataFrame(rows, (
        "column_name string, present_count long, null_count long, invalid_count long, negative_count long, zero_count long, min string, max string, "
        "sum string, max_integer_digits int, max_scale_digits int, suggested_type string"
    ))


def date_profile(df: DataFrame, column: str) -> DataFrame:
    text = _trimmed(column)
    day = P.iso_date(text)
    return df.agg(
        F.lit(column).alias("column_name"),
        F.count_if(text == "").alias("null_count"),
        F.count_if((text != "") & day.isNull()).alias("invalid_count"),
        F.min(day).cast("string").alias("min"),
        F.max(day).cast("string").alias("max"),
    )


def code_profile(df: DataFrame, column: str) -> DataFrame:
    """Integer-like code column; codes of any length are compared by sign, length and digits."""
    text = F.col("text")
    digits = F.regexp_replace(F.regexp_replace(text, r"[\s_+-]", ""), "^0+(?=[0-9])", "")
    below = text.rlike(r"^\s*-") & (digits != "0")
    code = F.when(text.rlike(P.INTEGER_TEXT), F.struct(below.alias("below"), F.length(digits).alias("size"), digits.alias("digits")))
    counts = df.groupBy(_trimmed(column).alias("text")).agg(F.count("*").alias("n")).withColumn("code", code)
    codes = counts.where("code IS NOT NULL").groupBy("code.below", "code.size", "code.digits").agg(F.count("*").alias("spellings"))
    distinct = codes.agg(F.count("*").alias("n"))
    size = F.struct("code.size", "code.digits")
    signed = lambda sign, found: F.concat(F.lit(sign), found["digits"])
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("text") == "", F.col("n"))), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when((F.col("text") != "") & F.col("code").isNull(), F.col("n"))), F.lit(0)).alias("invalid_count"),
        F.max(F.when(F.col("code.below"), size)).alias("deep"), F.min(F.when(F.col("code.below"), size)).alias("near"),
        F.max(F.when(~F.col("code.below"), size)).alias("high"), F.min(F.when(~F.col("code.below"), size)).alias("low"),
    ).select(
        F.lit(column).alias("column_name"), "null_count", "invalid_count",
        F.coalesce(signed("-", F.col("deep")), signed("", F.col("low"))).alias("min"), F.coalesce(signed("", F.col("high")), signed("-", F.col("near"))).alias("max"),
        distinct.scalar().alias("cardinality"),
    )


def invalid_values(df: DataFrame, column: str, parsed: Column) -> DataFrame:
    """Refused texts of a column with their counts."""
    text = _trimmed(column)
    return (
        df.select(text.alias("value"), parsed.alias("parsed"))
        .where("value <> '' AND parsed IS NULL")
        .groupBy("value")
        .agg(F.count("*").alias("count"))
        .select(F.lit(column).alias("column_name"), "value", "count")
    )


def sentinel_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each null spelling occurs per column."""
    trimmed = df.select(*[_trimmed(c).alias(c) for c in columns])
    return (
        stack_columns(trimmed, columns)
        .where(F.upper("value").isin(*NULL_SENTINELS))
        .groupBy("column_name", F.when(F.col("value") == "", "<empty>").otherwise(F.col("value")).alias("sentinel"))
        .agg(F.count("*").alias("count"))
    )


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, duplicate groups and rows in excess of one per key."""
    grouped = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"),
    ).withColumn("is_unique", F.col("excess_rows") == 0)


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count and share per column, with the physical type seen."""
    types = dict(df.dtypes)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("physical_type"),
                F.col("_rows").alias("rows"),
                F.col(c).alias("missing_count"),
                F.coalesce(100 * F.col(c) / F.nullif("_rows", F.lit(0)), F.lit(0.0)).alias("missing_percent"),
            )
            for c in columns
        ]
    )
    return counts.select(F.inline(rows))


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts, range and exact mean per numeric column in one aggregate."""
    aggregates = []
    for c in columns:
        value = F.col(c)
        total, seen = F.sum(value).cast("double"), F.count(value)
        aggregates.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("rows_seen"),
                seen.alias("valid_count"),
                F.count_if(value.isNull()).alias("missing_count"),
                F.count_if(value < 0).alias("negative_count"),
                F.count_if(value == 0).alias("zero_count"),
                F.min(value).cast("double").alias("min"),
                F.max(value).cast("double").alias("max"),
                F.when(seen > 0, total / seen).alias("mean"),
            ).alias(c)
        )
    return df.agg(*aggregates).select(F.inline(F.array(*columns)))


def slice_bounds(df: DataFrame, columns: Sequence[str], slices: int = SLICES) -> dict[str, list[float]]:
    """Rough cut points per column. Any cut points give exact quantiles; good ones balance the work."""
    levels = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), levels, F.lit(1000)).alias(c) for c in columns]).first()
    return {c: list(row[c] or []) for c in columns}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], levels: Sequence[float] = QUANTILES, slices: int = SLICES
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (column, level).

    A first pass counts rows per slice of the value axis, which tells the slices
    the wanted ranks fall in. Only values of those slices are shuffled, counted
    (so a hot value is one row) and ranked. No task sorts or holds a whole column.
    """
    bounds = slice_bounds(df, columns, slices)
    pieces = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).cast("double").alias("value"),
                slice_by_bounds(F.col(c).cast("double"), bounds[c]).alias("slice"),
            )
            for c in columns
        ]
    )
    stacked = df.select(F.inline(pieces)).where("value IS NOT NULL")
    per_slice = stacked.groupBy("column_name", "slice").agg(F.count("*").alias("rows"))
    whole = Window.partitionBy("column_name")
    upto = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = F.col("level") * (F.col("total") - 1)
    start = F.col("upto") - F.col("rows")

    def holds(rank: Column) -> Column:
        return (rank >= start) & (rank < F.col("upto"))

    # At most two (slice, level) pairs per level and column, so this stays tiny.
    targets = (
        per_slice.withColumns({"upto": F.sum("rows").over(upto), "total": F.sum("rows").over(whole)})
        .withColumn("level", F.explode(F.array(*[F.lit(q) for q in levels])))
        .withColumn("position", position)
        .where(holds(F.floor("position")) | holds(F.ceil("position")))
        .select("column_name", "slice", "level", "position", start.alias("start"))
    )
    wanted = F.broadcast(targets.select("column_name", "slice").distinct())
    counts = (
        stacked.join(wanted, ["column_name", "slice"], "left_semi")
        .groupBy("column_name", "slice", "value")
        .agg(F.count("*").alias("n"))
    )
    inside = Window.partitionBy("column_name", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("cum_n", F.sum("n").over(inside))

    # The value at 0-based rank r is the one whose running count first exceeds r.
    last = F.col("start") + F.col("cum_n") - 1
    first = last - F.col("n") + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= first) & (rank <= last), F.col("value")))

    picked = (
        ranked.join(targets, ["column_name", "slice"])
        .groupBy("column_name", "level", "position")
        .agg(at(F.floor("position")).alias("low"), at(F.ceil("position")).alias("high"))
    )
    weight = F.col("position") - F.floor("position")
    return picked.select("column_name", "level", (F.col("low") + (F.col("high") - F.col("low")) * weight).alias("value"))


def derived_profile(fact: DataFrame) -> DataFrame:
    """Stats of the derived claim measures and the yes/no split of HasClaim."""
    stats = numeric_stats(fact, ("total_claim_count", "total_claim_amount", "claim_frequency", "loss_ratio"))
    yes_no = fact.agg(
        F.count_if(F.col("has_claim") == 1).alias("yes"),
        F.count_if(F.col("has_claim") == 0).alias("no"),
        F.count_if(F.col("has_claim").isNull()).alias("missing"),
    )
    return stats.select(
        "*",
        *[yes_no.select(c).scalar().alias(f"has_claim_{c}") for c in ("yes", "no", "missing")],
    )


def cross_field_profile(df: DataFrame) -> DataFrame:
    """Contradictions between fields of a risk row, counted in one pass."""
    amount = " + ".join(c for c in df.columns if c.startswith("claim_amount_"))
    count = " + ".join(c for c in df.columns if c.startswith("claim_nb_"))
    rules = {
        "exposure_not_positive": "expos_total <= 0",
        "premium_not_positive": "prem_total <= 0",
        "amount_without_count": f"({amount}) > 0 AND ({count}) = 0",
        "count_without_amount": f"({count}) > 0 AND ({amount}) = 0",
        "partial_exposure_exceeds_total": "expos_fire_rob > expos_total",
        "partial_premium_exceeds_total": "prem_fire_rob > prem_total",
    }
    counts = df.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in rules.items()])
    pairs = ", ".join(f"'{name}', {name}" for name in rules)
    return counts.selectExpr(f"stack({len(rules)}, {pairs}) AS (observation, rows)")


def partition_duplicates(df: DataFrame, key: str, file: str = "source_file") -> DataFrame:
    """Rows per file and how many repeat a record of an earlier file or row.

    Every record counts once, in the first file that holds it. Only (record,
    file) counts move, so a record with very many copies stays one row per file.
    """
    per_file = df.groupBy(key, file).agg(F.count("*").alias("n"))
    firsts = per_file.groupBy(key).agg(F.min(file).alias(file)).groupBy(file).agg(F.count("*").alias("new_records"))
    rows = per_file.groupBy(file).agg(F.sum("n").alias("rows"))
    fresh = F.coalesce("new_records", F.lit(0))
    return rows.join(firsts, file, "left").select(file, "rows", (F.col("rows") - fresh).alias("duplicate_rows"))


def precision_profile(df: DataFrame, columns: Sequence[str], file: str = "source_file", row: str = "source_row_number") -> DataFrame:
    """Widest integer and fraction parts per decimal text column, and where they first occur."""
    pieces = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    )
    cells = df.select(file, row, F.inline(pieces))
    sized = P.with_decimal_parts(cells, "value").select(
        "column_name",
        file,
        row,
        F.when(F.col("digits").isNotNull(), F.greatest(F.lit(1), F.length("digits") - F.col("scale"))).alias("whole"),
        F.greatest(F.col("scale"), F.lit(0)).alias("places"),
    ).withColumn("places", F.when(F.col("whole").isNotNull(), F.col("places")))
    # One pass: there are few (file, widths) combinations, and all answers follow from them.
    shapes = sized.groupBy("column_name", file, "whole", "places").agg(
        F.count("*").alias("rows"), F.min(row).alias("first_row")
    )
    widest = shapes.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("places").isNull(), F.col("rows"))), F.lit(0)).alias("parse_errors"),
        F.coalesce(F.max("whole"), F.lit(0)).alias("max_integer_digits"),
        F.coalesce(F.max("places"), F.lit(0)).alias("max_fraction_digits"),
    )
    out = widest
    for measure, prefix in (("places", "fraction"), ("whole", "integer")):
        order = Window.partitionBy("column_name").orderBy(F.col(measure).desc_nulls_last(), file, "first_row")
        first = shapes.withColumn("_at", F.row_number().over(order)).where("_at = 1")
        reached = F.col(measure) > 0
        out = out.join(
            first.select(
                "column_name",
                F.when(reached, F.col(file)).alias(f"{prefix}_file"),
                F.when(reached, F.col("first_row")).alias(f"{prefix}_row"),
            ),
            "column_name",
            "left",
        )
    return out.withColumn(
        "recommended_type",
        F.format_string(
            "DECIMAL(%d,%d)", F.col("max_integer_digits") + F.col("max_fraction_digits"), F.col("max_fraction_digits")
        ),
    )
