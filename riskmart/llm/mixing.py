"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Documents fall into cells of source, language and topic. The cells' token weights are raked in turn to the three target marginals; a cell's factor is its
raked weight over its tokens. Inclusion probabilities are ``min(1, scale * factor)``, the scale being calibrated so that the expected tokens meet the
budget; a document is taken if its seeded hash lies below its probability. Only sums by cell leave the scan of the documents; cells are summed
map-side, so a hot source is no hot task, and every round over them is written, which keeps plans short. Up to ``LOCAL_CELLS`` cells are raked in one
partition, whose sums need no exchange and no broadcast; more are summed and joined like any table. Both ways do the same steps.

Targets: explicit shares by value, or else the marginal's own token shares to the power ``temper`` (below 1: small values gain). Shares are
normalised over the values that have tokens.

Defined cases: a null source or language is a value of its own (shown as null), a null text has no tokens. A cell without tokens has factor and
probability 0. Repeated rows are sampled alike; an empty table gives an empty result. ``mix`` keeps the columns of the input and nothing else, whatever
their names; ``probabilities`` returns its own columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import Store

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 8
BUDGET = 0.8
TEMPER = 0.7
BROADCAST_CELLS = 200_000
#: Up to this many cells a round is one task over one partition: a broadcast takes several MB of the driver however few rows it has, and a round has three.
LOCAL_CELLS = 100_000
#: Topics in order of precedence: the first pattern (SQL LIKE) that a text matches.
TOPICS: tuple[tuple[str, str], ...] = (("legal", "%Licensed under%"), ("contact", "%@%.%"), ("tabular", "% | %"), ("capitals", "%!! %"))
OTHER_TOPIC = "prose"


def topic_of(text: Column, topics: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(topics):
        out = F.when(text.like(pattern), F.lit(name)).otherwise(out)
    return out


def described(df: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """The whole row as ``row``, and the columns of mixing: keys (null has a key of its own), tokens, and the row's place in [0, 1)."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")), 1, 13)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key(source_col).alias("source"), key(lang_col).alias("lang"), topic_of(text).alias("topic"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"), (F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))).alias("place"),
    )


def _targets(cells: DataFrame, dimension: str, shares: dict[str, float] | None, temper: float) -> DataFrame:
    """Value and target tokens; the targets of a dimension add up to all tokens."""
    sums = cells.groupBy(dimension).agg(F.sum("n_tokens").cast("double").alias("own")).where("own > 0")
    if shares is None:
        aim = F.pow("own", F.lit(temper))
    else:
        aim = F.coalesce(*[F.when(F.col(dimension) == F.lit("=" + v), F.lit(float(s))) for v, s in shares.items()], F.lit(0.0))
    wanted = sums.withColumn("aim", aim)
    all_own, all_aim = wanted.agg(F.coalesce(F.sum("own"), F.lit(0.0)), F.coalesce(F.sum("aim"), F.lit(0.0))).first()
    return wanted.select(dimension, (F.col("aim") / F.lit(all_aim or 1.0) * F.lit(all_own)).alias("target"))


def raked_once(cells: DataFrame, few: bool) -> DataFrame:
    """One round: ``weight`` raked to the targets of one dimension after the other."""
    current = cells.coalesce(1) if few else cells
    for d in DIMENSIONS:
        if few:
            current = current.withColumn("now", F.sum("weight").over(Window.partitionBy(d)))
        else:
            current = current.join(current.groupBy(d).agg(F.sum("weight").alias("now")), d)
        current = current.withColumn("weight", F.when(F.col("now") > 0, F.col("weight") * (F.col(f"target_{d}") / F.col("now"))).otherwise(F.lit(0.0))).drop("now")
    return current


def raked(cells: DataFrame, store: Store, shares: dict[str, dict[str, float]], temper: float, rounds: int) -> DataFrame:
    """Adds ``weight``: tokens raked to the target marginals."""
    current = cells.withColumn("weight", F.col("n_tokens").cast("double"))
    for d in DIMENSIONS:
        current = current.join(_targets(cells, d, shares.get(d), temper).withColumnRenamed("target", f"target_{d}"), d, "left")
    current = store.put(current.fillna(0.0), "raked-start")
    few = current.count() <= LOCAL_CELLS
    for number in range(rounds):
        current = store.put(raked_once(current, few), f"raked-{number}")
        if number:
            store.drop(f"raked-{number - 1}")
    return current


def calibrated(cells: DataFrame, budget: float) -> DataFrame:
    """Adds ``factor`` and ``probability``. Each step fixes the cells at probability 1 and spreads the rest of the budget; it ends when none joins them."""
    cells = cells.withColumn("factor", F.when(F.col("n_tokens") > 0, F.col("weight") / F.col("n_tokens")).otherwise(F.lit(0.0)))
    scale, full = None, -1
    while True:
        capped = F.lit(False) if scale is None else F.col("factor") * F.lit(scale) >= 1
        n, tokens, held, rest = cells.agg(
            F.count_if(capped), F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum(F.when(capped, F.col("n_tokens"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == full or rest <= 0:
            break
        scale, full = (budget * tokens - held) / rest, n
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("factor") * F.lit(scale or 0.0)))


def sampled(
    df: DataFrame, budget: float = BUDGET, shares: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, rounds: int = ROUNDS, seed: int = 29,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """Every row as ``row``, with its keys, tokens, factor, probability and ``selected``."""
    store = Store(df.sparkSession, "mixing")
    rows = described(df, seed, id_col, text_col, source_col, lang_col)
    cells = store.put(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "cells")
    priced = store.put(calibrated(raked(cells, store, shares or {}, temper, rounds), budget).select(*DIMENSIONS, "factor", "probability"), "priced")
    few = priced.count() <= BROADCAST_CELLS
    return rows.join(F.broadcast(priced) if few else priced, list(DIMENSIONS)).withColumn("selected", F.col("place") < F.col("probability"))


def probabilities(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, source, language, topic, tokens, factor, probability, selected."""
    shown = lambda c: F.when(F.col(c) != "null", F.substring(F.col(c), 2, 2**30)).alias(c)
    return sampled(df, id_col=id_col, **options).select(
        F.col(f"row.{id_col}").alias(id_col), shown("source"), shown("lang"), "topic", "n_tokens",
        F.round("factor", 8).alias("factor"), F.round("probability", 8).alias("probability"), "selected",
    )


def mix(df: DataFrame, **options) -> DataFrame:
    """The sampled documents, with the columns of the input."""
    return sampled(df, **options).where("selected").select("row.*")
