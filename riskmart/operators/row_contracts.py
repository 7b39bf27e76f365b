"""Row contracts: typed columns, the first broken rule, and the two policies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.functions import hashing as H
from riskmart.functions import parsing as P


class SourceContractError(ValueError):
    """A source breaks a hard rule of its contract."""


# A row mark made where the values are parsed. Spark pushes no filter below a
# column like this, so a filter on the reason cannot copy the parsers into itself.
MARK = "_mark"


@dataclass(frozen=True)
class Rule:
    """``ok`` must hold; ``problem`` says what is wrong when it does not."""

    field: str
    ok: Column
    problem: Column


def with_reason(df: DataFrame, rules: Sequence[Rule], row_number: str) -> DataFrame:
    """Adds ``reject_reason``: the first broken rule in words, NULL for a good row.

    First the position of the rule, then its wording, as two small projections.
    """
    broken = [F.when(~F.coalesce(rule.ok, F.lit(False)), F.lit(at)) for at, rule in enumerate(rules)]
    df = df.withColumn("_broken", F.coalesce(*broken))
    # One lookup, not a branch per rule: a filter pushed down here must not copy the rules many times.
    words = F.array(*[F.concat(F.lit(f": {rule.field} "), rule.problem) for rule in rules])
    text = F.concat(F.lit("row "), F.col(row_number).cast("string"), F.element_at(words, F.col("_broken") + 1))
    found = F.col("_broken").isNotNull() & (F.col(MARK) >= 0)
    return df.withColumn("reject_reason", F.when(found, F.substring(text, 1, C.REASON_LIMIT))).drop("_broken", MARK)


def cell(name: str) -> Column:
    """Source text of a cell. In a row of the right width NULL means blank."""
    return F.coalesce(F.col(name), F.lit(""))


def text_column(name: str) -> str:
    """Where the source text of a cell waits for the rules."""
    return f"_text_{name}"


def plain_column(name: str) -> str:
    """Where the decimal literal of a cell waits; NULL if it is none."""
    return f"_plain_{name}"


def with_texts(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moves the raw cells aside, so that typed columns can take their names."""
    kept = [c for c in raw.columns if c not in columns]
    return raw.select(*kept, *[cell(c).alias(text_column(c)) for c in columns])


def required_text_rule(name: str, limit: int) -> Rule:
    text = F.col(text_column(name))
    problem = F.when(text == "", F.lit("is required")).otherwise(F.lit(f"is longer than {limit} characters"))
    return Rule(name, (text != "") & (F.length(text) <= limit), problem)


def optional_text_rule(name: str, limit: int) -> Rule:
    return Rule(name, F.length(text_column(name)) <= limit, F.lit(f"is longer than {limit} characters"))


def decimal_rule(name: str, nullable_na: bool = False) -> Rule:
    """The typed column is already there; NULL in it means the text was refused."""
    text = F.col(text_column(name))
    problem = (
        F.when(text == "", F.lit("is required"))
        .when(F.col(plain_column(name)).isNull(), F.lit("is not a finite decimal"))
        .otherwise(F.lit("does not fit the declared decimal"))
    )
    ok = F.col(name).isNotNull()
    return Rule(name, (text == "NA") | ok if nullable_na else ok, problem)


def market_rules(width_error: Column) -> list[Rule]:
    code, month = F.col(text_column("company_code")), F.col(text_column("year_month"))
    code_problem = (
        F.when(code == "", F.lit("is required"))
        .when(code.rlike(P.CANONICAL_INT), F.lit("is outside int32"))
        .otherwise(F.lit("is not a canonical integer"))
    )
    month_problem = (
        F.when(month == "", F.lit("is required"))
        .when(P.iso_date(month).isNotNull(), F.lit("is not the first day of a month"))
        .otherwise(F.lit("is not an ISO date"))
    )
    return [
        Rule("row", ~width_error, F.lit("has more cells than the contract")),
        Rule("company_code", F.col("company_code").isNotNull(), code_problem),
        required_text_rule("company_name", C.MARKET_TEXT_LIMITS["company_name"]),
        Rule("year_month", F.col("year_month").isNotNull(), month_problem),
        required_text_rule("product", C.MARKET_TEXT_LIMITS["product"]),
        required_text_rule("state", C.MARKET_TEXT_LIMITS["state"]),
        decimal_rule("premiums"),
        decimal_rule("claims"),
        decimal_rule("claim_premium_ratio", nullable_na=True),
    ]


def apply_market_contract(raw: DataFrame, row_number: str = "source_row_number") -> DataFrame:
    """Typed market columns next to the source text, plus hash, payload and reason.

    ``raw`` has the eight text columns and a row number; the optional columns
    ``extra_cells``, ``cells`` and ``raw_line`` come from the CSV reader. The
    payload of a refused row has null for a cell that was not there, and the whole
    source line if the row has another width than the contract. Values are parsed in
    one projection and judged in the next, so no parse is evaluated twice.
    """
    extra = F.col("extra_cells") if "extra_cells" in raw.columns else F.lit(False)
    text = {c: F.col(text_column(c)) for c in C.MARKET_COLUMNS}
    hashed = [
        F.when(F.col("cells") <= position, F.lit(H.MISSING_CELL)).otherwise(text[c]) if "cells" in raw.columns else text[c]
        for position, c in enumerate(C.MARKET_COLUMNS)
    ]
    lineage = [c for c in raw.columns if c not in C.MARKET_COLUMNS]
    decimals = {plain_column(c): text_column(c) for c in C.MARKET_DECIMALS}
    plain = P.with_plain_decimals(with_texts(raw, C.MARKET_COLUMNS), decimals)
    parsed = plain.select(
        F.monotonically_increasing_id().alias(MARK),
        *lineage,
        *text.values(),
        *decimals,
        H.text_record_hash(hashed).alias("record_hash"),
        P.canonical_int(text["company_code"]).alias("company_code"),
        P.month_start(text["year_month"]).alias("year_month"),
        F.nullif(text["claim_premium_ratio"], F.lit("NA")).alias("claim_premium_ratio_raw"),
        *[P.half_even_decimal(F.col(plain_column(c))).alias(c) for c in C.MARKET_DECIMALS],
    )
    def given(position: int, c: str) -> Column:
        return F.when(F.col("cells") > position, text[c]) if "cells" in raw.columns else text[c]

    sent = [given(position, c).alias(c) for position, c in enumerate(C.MARKET_COLUMNS)]
    if "raw_line" in raw.columns:
        sent.append(F.col("raw_line"))
    payload = F.to_json(F.struct(*sent), {"ignoreNullFields": "false"} if "cells" in raw.columns else {})
    judged = with_reason(parsed, market_rules(extra), row_number)
    return judged.select(
        *lineage,
        "record_hash",
        F.when(F.col("reject_reason").isNotNull(), payload).alias("raw_payload"),
        "reject_reason",
        "company_code",
        text["company_name"].alias("company_name"),
        "year_month",
        text["product"].alias("product"),
        text["state"].alias("state"),
        text["premiums"].alias("premiums_raw"),
        "premiums",
        text["claims"].alias("claims_raw"),
        "claims",
        "claim_premium_ratio_raw",
        "claim_premium_ratio",
    )


def split_rows(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): the quarantine policy.

    Pass rows that are already written, or both sides parse the source again.
    """
    accepted = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_payload")
    rejected = checked.filter(F.col("reject_reason").isNotNull())
    return accepted, rejected


def risk_rules(width_error: Column, missing: Column | None = None) -> list[Rule]:
    rules = [Rule("row", ~width_error, F.lit("has more cells than the contract"))]
    if missing is not None:
        rules.append(Rule("row", ~missing, F.lit("has fewer cells than the contract")))
    rules += [optional_text_rule(name, limit) for name, limit in C.RISK_TEXT_LIMITS.items()]
    rules.append(
        Rule(
            "VehYear",
            (F.col(text_column("VehYear")) == "") | F.col("VehYear").isNotNull(),
            F.lit("is not a non-negative 16-bit integer"),
        )
    )
    rules += [decimal_rule(name) for name in C.RISK_DECIMALS]
    for name in C.RISK_COUNTS:
        problem = F.when(F.col(text_column(name)) == "", F.lit("is required")).otherwise(
            F.lit("is not a non-negative 32-bit integer")
        )
        rules.append(Rule(name, F.col(name).isNotNull(), problem))
    both = F.col("State").isNull() == F.col("StateAb").isNull()
    rules.append(Rule("State", both, F.lit("and StateAb must be null together")))
    return rules


def apply_risk_contract(raw: DataFrame, row_number: str = "source_row_number") -> DataFrame:
    """Typed risk columns with the record hash and the first broken rule."""
    extra = F.col("extra_cells") if "extra_cells" in raw.columns else F.lit(False)
    missing = (F.col("cells") < len(C.RISK_COLUMNS)) if "cells" in raw.columns else None
    lineage = [c for c in raw.columns if c not in C.RISK_COLUMNS]
    text = {c: F.col(text_column(c)) for c in C.RISK_COLUMNS}
    typed = []
    for name in C.RISK_COLUMNS:
        if name in C.RISK_DECIMALS:
            value = P.exact_decimal(F.col(plain_column(name)), *C.RISK_DECIMALS[name])
        elif name in C.RISK_TEXT_LIMITS:
            value = F.nullif(text[name], F.lit(""))
        else:
            value = P.nonneg_int(text[name], "smallint" if name == "VehYear" else "int")
        typed.append(value.alias(name))
    literals = {plain_column(c): P.decimal_literal(text[c]) for c in C.RISK_DECIMALS}
    parsed = with_texts(raw, C.RISK_COLUMNS).withColumns(literals).select(
        F.monotonically_increasing_id().alias(MARK), *lineage, *text.values(), *literals, *typed
    )
    hashed = []
    for name in C.RISK_COLUMNS:
        if name in C.RISK_DECIMALS:
            spelled = P.exact_decimal_text(F.col(plain_column(name)), F.col(name))
            hashed.append((name, "decimal", spelled))
        else:
            hashed.append((name, "text" if name in C.RISK_TEXT_LIMITS else "int", F.col(name)))
    judged = with_reason(parsed, risk_rules(extra, missing), row_number)
    return judged.select(
        *lineage, H.typed_record_hash(hashed).alias("record_hash"), "reject_reason", *C.RISK_COLUMNS
    )


def contract_violations(checked: DataFrame, file: str = "source_file") -> DataFrame:
    """Rows and bad rows per file, with the first bad row and its reason, in one aggregate."""
    bad = F.col("reject_reason").isNotNull()
    number = F.when(bad, F.col("source_row_number"))
    return checked.groupBy(file).agg(
        F.count("*").alias("source_rows"),
        F.count_if(bad).alias("bad_rows"),
        F.min(number).alias("first_bad_row"),
        F.min_by("reject_reason", number).alias("first_reason"),
    )


def require_clean(checked: DataFrame) -> None:
    """Fail-fast policy: any bad row stops the load before anything is published."""
    worst = (
        contract_violations(checked)
        .filter(F.col("bad_rows") > 0)
        .orderBy("source_file")
        .limit(1)
        .collect()
    )
    if worst:
        row = worst[0]
        raise SourceContractError(f"{row.source_file}: {row.bad_rows} bad rows; first: {row.first_reason}")
