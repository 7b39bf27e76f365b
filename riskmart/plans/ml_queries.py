"""Population, splits, metrics and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators import ml as L
from riskmart.operators.warehouse import described_risk
from riskmart.plans.fixtures import MODEL_VERSION, SCORE_POPULATION, Sources
from riskmart.plans.registry import query
from riskmart.plans.scoring import prediction_table
from riskmart.plans.training import BASELINE
from riskmart.sources.tables import new_folder

CAP = 20_000
_SALTED = "upper(sha256(record_hash || ':{salt}'))"
_GROUPS = "(SELECT DISTINCT record_hash, has_claim FROM fact_risk)"


def _population_sql(positive: int, negative: int) -> str:
    return f"""SELECT f.* FROM fact_risk f WHERE record_hash IN (SELECT record_hash FROM (
  SELECT record_hash, has_claim, row_number() OVER (PARTITION BY has_claim ORDER BY record_hash) AS r FROM {_GROUPS})
  WHERE r <= CASE WHEN has_claim = 1 THEN {positive} ELSE {negative} END)"""


POPULATION = _population_sql(C.POSITIVE_GROUP_QUOTA, C.NEGATIVE_GROUP_QUOTA)
SMALL_QUOTAS = (200, 900)


def _splits_sql(rows: str) -> str:
    return f"""SELECT p.*, s.split FROM ({rows}) p JOIN (SELECT record_hash, has_claim, CASE (r - 1) % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT record_hash, has_claim, row_number() OVER (PARTITION BY has_claim ORDER BY {_SALTED.format(salt=L.SEED)}, record_hash) AS r
    FROM (SELECT DISTINCT record_hash, has_claim FROM ({rows})))) s USING (record_hash, has_claim)"""


SPLITS, ALL_SPLITS = _splits_sql(POPULATION), _splits_sql("SELECT * FROM fact_risk")


def _population(src: Sources) -> DataFrame:
    return src.table("ml_population", lambda: described_risk(L.bounded_population(src.fact_risk), src.risk_dims))


def _splits(src: Sources) -> DataFrame:
    return src.table("ml_splits", lambda: L.assign_splits(_population(src)))


@query(
    "ml_population",
    f"SELECT source_file, source_row_number, record_hash, has_claim, gender, driv_age, veh_model, state_ab FROM ({POPULATION})",
)
def ml_population(src: Sources) -> DataFrame:
    return _population(src).select(
        "source_file", "source_row_number", "record_hash", "has_claim", "gender", "driv_age", "veh_model", "state_ab"
    )


@query("ml_population_quota", f"SELECT source_file, source_row_number, record_hash, has_claim FROM ({_population_sql(*SMALL_QUOTAS)})")
def ml_population_quota(src: Sources) -> DataFrame:
    """Quotas that leave groups out at every scale."""
    return L.bounded_population(src.fact_risk, *SMALL_QUOTAS).select("source_file", "source_row_number", "record_hash", "has_claim")


@query(
    "ml_split_summary",
    f"""SELECT split, count(*) AS rows, CAST(sum(has_claim) AS BIGINT) AS positive_rows, count_if(has_claim = 0)::BIGINT AS negative_rows,
  round(avg(has_claim), 9) AS positive_rate, count(DISTINCT record_hash) AS distinct_groups, count(*) - count(DISTINCT record_hash) AS duplicate_excess
FROM ({ALL_SPLITS}) GROUP BY split""",
)
def ml_split_summary(src: Sources) -> DataFrame:
    """The split of all record groups of the fact, whatever the training population takes of them."""
    groups = src.table("record_groups", lambda: L.record_groups(src.fact_risk_rows))
    return L.split_summary(L.assign_splits(groups, grouped=True), L.GROUP_ROWS, (L.SLICE,))


@query("ml_split_leak", f"SELECT record_hash FROM ({SPLITS}) GROUP BY 1 HAVING count(DISTINCT split) > 1")
def ml_split_leak(src: Sources) -> DataFrame:
    return L.split_leaks(_splits(src))


@query(
    "ml_cap",
    f"""WITH g AS (SELECT record_hash, has_claim, row_number() OVER (PARTITION BY has_claim ORDER BY {_SALTED.format(salt=f'{L.SEED}:{CAP}')}, record_hash) AS r,
  count(*) OVER (PARTITION BY has_claim) AS n FROM {_GROUPS}),
kept AS (SELECT record_hash FROM g WHERE r <= round(n * least(1.0, CAST({CAP} AS DOUBLE) / (SELECT count(*) FROM fact_risk))))
SELECT has_claim, count(*) AS rows, count(DISTINCT record_hash) AS groups, min(record_hash) AS first_group, max(record_hash) AS last_group
FROM fact_risk WHERE record_hash IN (SELECT record_hash FROM kept) GROUP BY 1""",
)
def ml_cap(src: Sources) -> DataFrame:
    """What a cap keeps: whole groups, the same share per label."""
    return L.stratified_cap(src.fact_risk, CAP).groupBy("has_claim").agg(
        F.count("*").alias("rows"),
        F.count_distinct("record_hash").alias("groups"),
        F.min("record_hash").alias("first_group"),
        F.max("record_hash").alias("last_group"),
    )


_STACK = "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM t" for c in L.FEATURES)


@query(
    "ml_modes",
    f"""WITH t AS (SELECT * FROM fx_risk), c AS (SELECT column_name, value, count(*) AS "count" FROM ({_STACK}) WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT column_name, value, "count" FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY "count" DESC, value) AS r FROM c) WHERE r = 1""",
)
def ml_modes(src: Sources) -> DataFrame:
    return L.feature_modes(src.risk)


@query(
    "ml_majority",
    """SELECT count_if(has_claim = 0)::BIGINT AS negative, count_if(has_claim = 1)::BIGINT AS positive,
  CASE WHEN count_if(has_claim = 1) > count_if(has_claim = 0) THEN 1 ELSE 0 END AS majority_label FROM fact_risk""",
)
def ml_majority(src: Sources) -> DataFrame:
    return L.majority(src.fact_risk)


def metrics_sql(source: str, group: str) -> str:
    part = f"PARTITION BY {group} " if group else ""
    pick, by = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"""SELECT {pick}CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
  round(sum(n * (tp - p / 2)) / (sum(p) * sum(n)), 9) AS roc_auc, round(sum(p * tp / (tp + fp)) / sum(p), 9) AS average_precision
FROM (SELECT *, sum(p) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp, sum(n) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp
  FROM (SELECT {pick}score, CAST(sum(has_claim) AS DOUBLE) AS p, CAST(sum(1 - has_claim) AS DOUBLE) AS n FROM {source} GROUP BY {pick}score)){by}"""


@query("ml_metrics", metrics_sql("fx_scores", ""))
def ml_metrics(src: Sources) -> DataFrame:
    return L.ranking_metrics(src.scores).withColumns(
        {c: F.round(c, 9) for c in ("roc_auc", "average_precision")}
    )


@query(
    "ml_confusion",
    """WITH c AS (SELECT count(*) AS rows, count_if(score >= 0.5 AND has_claim = 1)::BIGINT AS tp, count_if(score >= 0.5 AND has_claim = 0)::BIGINT AS fp,
  count_if(score < 0.5 AND has_claim = 1)::BIGINT AS fn, count_if(score < 0.5 AND has_claim = 0)::BIGINT AS tn,
  CAST(min(score) AS DOUBLE) AS score_min, CAST(max(score) AS DOUBLE) AS score_max FROM fx_scores)
SELECT *, round((tp + fn) / rows, 9) AS positive_rate, round((tp + tn) / rows, 9) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1 FROM c""",
)
def ml_confusion(src: Sources) -> DataFrame:
    rates = ("positive_rate", "accuracy", "precision", "recall", "f1")
    result = L.confusion(src.scores).withColumns({c: F.round(c, 9) for c in rates})
    return result.withColumns({c: F.col(c).cast("double") for c in ("score_min", "score_max")})


_CANDIDATES = """(SELECT 'linear' AS model, score, has_claim FROM fx_scores
  UNION ALL SELECT 'bayes', CAST(1 - score AS DECIMAL(12,10)), has_claim FROM fx_scores)"""


@query(
    "ml_selection",
    f"""SELECT model AS selected_model, average_precision, roc_auc FROM ({metrics_sql(_CANDIDATES, 'model')})
ORDER BY average_precision DESC, roc_auc DESC, model = 'linear' DESC LIMIT 1""",
)
def ml_selection(src: Sources) -> DataFrame:
    """Metrics of two candidate score sets in one pass, then the better one."""
    linear = src.scores.select(F.lit("linear").alias("model"), "score", "has_claim")
    bayes = src.scores.select(
        F.lit("bayes").alias("model"), (1 - F.col("score")).cast("decimal(12,10)").alias("score"), "has_claim"
    )
    metrics = L.ranking_metrics(linear.unionByName(bayes), ("model",))
    return L.select_model(metrics, "linear").withColumns({c: F.round(c, 9) for c in ("roc_auc", "average_precision")})


@query(
    "ml_matrix_shape",
    f"""WITH s AS (SELECT split, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in L.FEATURES)} FROM ({SPLITS}) x JOIN fx_risk USING (source_file, source_row_number)),
a AS (SELECT split, column_name, value FROM ({' UNION ALL '.join(f"SELECT split, '{c}' AS column_name, {c} AS value FROM s" for c in L.FEATURES)})),
known AS (SELECT DISTINCT column_name, value FROM a WHERE split = 'train' AND value IS NOT NULL)
SELECT (SELECT count(*) FROM s WHERE split = 'validation') AS rows, (SELECT count(*) FROM known) AS columns, count(*) AS nonzero_values,
  round(count(*) / ((SELECT count(*) FROM s WHERE split = 'validation') * (SELECT count(*) FROM known)), 9) AS density
FROM a WHERE split = 'validation' AND (value IS NULL OR EXISTS (SELECT 1 FROM known k WHERE k.column_name = a.column_name AND k.value = a.value))""".replace(
        f"FROM ({SPLITS}) x JOIN fx_risk USING", f"FROM (SELECT source_file, source_row_number, split FROM ({SPLITS})) x JOIN fx_risk USING"
    ),
)
def ml_matrix_shape(src: Sources) -> DataFrame:
    rows = _splits(src)
    shape = L.matrix_shape(rows.where("split = 'train'"), rows.where("split = 'validation'"))
    return shape.withColumn("density", F.round("density", 9))


def _runs(src: Sources) -> tuple[DataFrame, DataFrame]:
    """A first run over files 0-2 and a rerun over files 2-4."""
    first = src.scores.where("source_file <= 'part2.csv'").withColumn("score", (F.col("score") * F.lit("0.5").cast("decimal(2,1)")))
    second = src.scores.where("source_file >= 'part2.csv'")
    return (
        L.predictions(first, SCORE_POPULATION, MODEL_VERSION, "run-1"),
        L.predictions(second, SCORE_POPULATION, MODEL_VERSION, "run-2"),
    )


@query(
    "prediction_upsert",
    """SELECT source_file, source_version, source_row_number, record_hash, 'bounded_held_out_test' AS population, 'claim_risk_model_v001' AS model_version,
  CAST(s AS DOUBLE) AS score, s >= 0.5 AS predicted_claim, run_id FROM (
    SELECT *, CASE WHEN source_file >= 'part2.csv' THEN 'run-2' ELSE 'run-1' END AS run_id,
      CASE WHEN source_file >= 'part2.csv' THEN score ELSE CAST(score * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(12,10)) END AS s FROM fx_scores)""",
)
def prediction_upsert(src: Sources) -> DataFrame:
    """Both runs upserted into a stored table of key buckets; the last published state."""
    return _stored_predictions(src).drop("threshold").withColumn("score", F.col("score").cast("double"))


def _stored_predictions(src: Sources) -> DataFrame:
    table = prediction_table(src.spark, new_folder(src.spark, "predictions"), buckets=16)
    for run in _runs(src):
        state = table.upsert(run)
    return table.read(state)


_ID = ", ".join(L.IDENTITY)
_DAMAGED = "SELECT * FROM fx_scores WHERE source_row_number % 1009 <> 0 UNION ALL SELECT * FROM fx_scores WHERE source_row_number % 997 = 1"


def _recon_sql(case: str, stored: str) -> str:
    return f"""SELECT '{case}' AS case_name, (SELECT count(*) FROM ({stored})) AS stored_rows, count_if(s > 0) AS distinct_identities, count_if(s > 1) AS duplicate_identities,
  CAST(sum(e) AS BIGINT) AS expected_rows, count_if(s > 0 AND e = 0) AS unexpected_identities, count_if(s = 0 AND e > 0) AS missing_identities,
  CASE WHEN (SELECT count(*) FROM ({stored})) = sum(e) AND count_if(s > 1) + count_if(s > 0 AND e = 0) + count_if(s = 0 AND e > 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT {_ID}, sum(s) AS s, sum(e) AS e FROM (SELECT {_ID}, 1 AS s, 0 AS e FROM ({stored}) UNION ALL SELECT {_ID}, 0, 1 FROM fact_risk) GROUP BY ALL)"""


@query("prediction_recon", f"{_recon_sql('stored', 'SELECT * FROM fx_scores')} UNION ALL {_recon_sql('damaged', _DAMAGED)}")
def prediction_recon(src: Sources) -> DataFrame:
    """The stored predictions, and a damaged copy: some rows missing, some twice."""
    number = F.col("source_row_number")
    copies = {"stored": F.lit(1), "damaged": (number % 1009 != 0).cast("int") + (number % 997 == 1).cast("int")}
    return L.prediction_reconciliation(_stored_predictions(src), src.fact_risk_rows, copies)


def _cap_sql(cap: int) -> str:
    """What ``stratified_cap`` keeps of the training split."""
    return f"""SELECT {cap} AS cap, 'train' AS split, count(*) AS rows, count(DISTINCT record_hash) AS groups, CAST(sum(has_claim) AS BIGINT) AS positives FROM t WHERE record_hash IN (
  SELECT record_hash FROM (SELECT record_hash, has_claim, row_number() OVER (PARTITION BY has_claim ORDER BY {_SALTED.format(salt=f'{L.SEED}:{cap}')}, record_hash) AS r,
    count(*) OVER (PARTITION BY has_claim) AS n FROM (SELECT DISTINCT record_hash, has_claim FROM t))
  WHERE r <= round(n * least(1.0, CAST({cap} AS DOUBLE) / (SELECT count(*) FROM t))))"""


_WHOLE = "SELECT {n} AS cap, split, count(*) AS rows, count(DISTINCT record_hash) AS groups, CAST(sum(has_claim) AS BIGINT) AS positives FROM s WHERE split = '{split}' GROUP BY split"


@query(
    "ml_train_caps",
    f"WITH s AS MATERIALIZED ({SPLITS}), t AS (SELECT * FROM s WHERE split = 'train') "
    + " UNION ALL ".join([*map(_cap_sql, C.TRAIN_CAPS), *(_WHOLE.format(n=0, split=split) for split in ("train", "validation", "test"))]),
)
def ml_train_caps(src: Sources) -> DataFrame:
    """Rows, groups and positives that each training cap keeps, and those of the splits (cap 0)."""
    rows = _splits(src)
    sizes = [F.count("*").alias("rows"), F.count_distinct("record_hash").alias("groups"), F.sum("has_claim").alias("positives")]
    found = rows.groupBy("split").agg(*sizes).select(F.lit(0).alias("cap"), "split", "rows", "groups", "positives")
    train = rows.where("split = 'train'")
    for cap in C.TRAIN_CAPS:
        found = found.unionByName(L.stratified_cap(train, cap).agg(*sizes).select(F.lit(cap).alias("cap"), F.lit("train").alias("split"), "rows", "groups", "positives"))
    return found


@query("ml_train_select")
def ml_train_select(src: Sources) -> DataFrame:
    """Averaged SGD and complement Bayes fitted under the last cap, measured on validation, the better one chosen."""
    rows = _splits(src)
    train, validation = rows.where("split = 'train'"), rows.where("split = 'validation'")
    capped = src.table("ml_train", lambda: L.stratified_cap(train, C.TRAIN_CAPS[-1]))
    measured = [L.evaluate(fit(capped), validation, kind) for kind, (_, fit) in L.MODELS.items()]
    return L.select_model(measured[0].unionByName(measured[1]), BASELINE)
