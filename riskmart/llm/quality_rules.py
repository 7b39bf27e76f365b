"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once for a document. The ledger keeps its measurements and one failure bit for each rule; policies are masks over
these bits, so another policy or an ablation never reads a text again.

Defined cases: a null text has no words (all measurements 0) and fails the base rules; an empty text likewise. Repeated rows stay separate
rows. An empty table gives an empty ledger. Columns beside ``id_col`` and ``text_col`` are not carried, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import SPACES

WINDOW = 8
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rules in bit order: name and the condition under which a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 and 100 * n_dup_lines > 40 * n_lines",
    "short_words": "2 * word_chars < 5 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "capitals": "100 * n_upper > 50 * word_chars",
    "exclamations": "10 * n_exclaims > 3 * n_words",
    "stutter": "100 * n_stutter > 20 * n_words",
}
#: Policies by version: the rules a document must pass.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(rule) for rule in rules)


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: measurements and ``rule_bits`` (bit i is set if rule i fails)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(F.col(id_col).alias("_id"), text.alias("_text"))
    worded = base.select("_id", "_text", F.filter(F.split("_text", _SPACE), lambda w: w != "").alias("_words"))
    hashed = worded.select(
        "_id", F.size("_words").cast("long").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_w"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        _count(F.col("_text"), _SYMBOLS).alias("n_symbols"),
        _count(F.col("_text"), _UPPER).alias("n_upper"),
        _count(F.col("_text"), "!").alias("n_exclaims"),
        F.filter(F.split("_text", "\n"), lambda line: F.translate(line, SPACES, "") != "").alias("_lines"),
    )
    measured = ["_id", "n_words", "word_chars", "n_symbols", "n_upper", "n_exclaims"]
    windows = hashed.select(
        *measured, F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda w, i: F.get("_w", i - 1) == w)).cast("long").alias("n_stutter"),
        F.when(F.col("n_words") >= WINDOW, F.transform(
            F.sequence(F.lit(1), (F.col("n_words") - (WINDOW - 1)).cast("int")), lambda i: F.xxhash64(F.slice("_w", i, F.lit(WINDOW)))
        )).alias("_h"),
    )
    measured += ["n_lines", "n_dup_lines", "n_stutter"]
    # Only a document with a repeated window is sorted: equal windows then stand side by side.
    ordered = windows.select(*measured, F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).alias("_s"))
    found = ordered.select(*measured, F.sort_array(F.transform(
        F.filter("_s", lambda e, j: F.coalesce(F.get("_s", j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get("_s", j + 1)["h"] == e["h"], F.lit(False))),
        lambda e: e["i"],
    )).alias("_p"))
    covered = F.aggregate(
        F.transform("_p", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", j + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    complete = found.select(*measured, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))
    bits = F.lit(0).cast("long")
    for bit, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return complete.select(F.col("_id").alias(id_col), *measured[1:], "n_repeat_words", bits.alias("rule_bits"))


def judged(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Adds ``base_failed`` and ``kept`` under a policy version: two bit tests on the ledger."""
    fails = lambda version: F.col("rule_bits").bitwiseAND(F.lit(mask_of(POLICIES[version]))) != 0
    return rows.withColumns({"base_failed": fails("base"), "kept": ~fails("base") & ~fails(policy), "policy": F.lit(policy)})


def ablation(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that stay if it is left out.

    One aggregate of bit tests over the ledger; the result has one row for each rule.
    """
    mask = mask_of(POLICIES[policy])
    hit = F.col("rule_bits").bitwiseAND(F.lit(mask))
    sums = [F.count(F.lit(1)).alias("n_docs"), F.count_if(hit == 0).alias("n_kept")]
    for rule in POLICIES[policy]:
        bit = mask_of((rule,))
        sums += [F.count_if(hit.bitwiseAND(F.lit(bit)) != 0).alias(f"f_{rule}"), F.count_if(hit == F.lit(bit)).alias(f"o_{rule}")]
    total = rows.agg(*sums)
    return total.select("n_docs", "n_kept", F.explode(F.array(*[F.struct(
        F.lit(rule).alias("rule"), F.col(f"f_{rule}").alias("n_failed"), F.col(f"o_{rule}").alias("n_failed_alone"),
        (F.col("n_kept") + F.col(f"o_{rule}")).alias("n_kept_without"),
    ) for rule in POLICIES[policy]])).alias("r")).select("r.*", "n_docs", "n_kept")
