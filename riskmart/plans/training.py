"""Training job: candidates over growing caps, choice on validation, refit, one test evaluation, saved model with a reload check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators import ml as L
from riskmart.sources.tables import work_folder, write_table

BASELINE = "sgd_logistic"
RELOAD_ROWS = 100


class ReloadError(RuntimeError):
    """The model that was read back scores differently from the one that was saved."""


@dataclass(frozen=True)
class TrainingResult:
    selected_model: str
    progress: list  # one row for each cap: cap, rows, positives, roc_auc, average_precision of the baseline on validation
    candidates: list  # one row for each kind of model at the last cap
    test: object  # metrics of the refitted model on the test split
    metadata: dict[str, str]


def _measured(model, rows: DataFrame, name: str, folder: str):
    """Ranking and threshold metrics of a model, from scores that are computed once."""
    scored = write_table(model.score(rows), f"{folder}/scores-{name}")
    ranking = L.ranking_metrics(scored).first()
    return {"model": name, **ranking.asDict(), **L.confusion(scored).first().asDict()}


def train_claim_model(
    spark: SparkSession, splits: DataFrame, path: str, model_version: str, caps: Sequence[int] = C.TRAIN_CAPS, kinds: Sequence[str] = tuple(L.MODELS)
) -> TrainingResult:
    """``splits``: rows with features, label, identity and split. Saves the chosen model, refitted on training and validation rows, under ``path``."""
    L.require_population(splits)
    leak = L.split_leaks(splits).first()
    if leak:
        raise L.PopulationError(f"group {leak[0]} is in more than one split")
    fit = {kind: L.MODELS[kind][1] for kind in kinds}
    with work_folder(spark, "training") as folder:
        rows = write_table(splits, f"{folder}/splits")
        part = {name: rows.where(F.col(L.SPLIT) == name) for name in ("train", "validation", "test")}
        progress, last = [], None
        for cap in caps:
            last = write_table(L.stratified_cap(part["train"], cap), f"{folder}/train-{cap}")
            found = _measured(fit[BASELINE](last), part["validation"], f"{BASELINE}-{cap}", folder)
            size = last.agg(F.count("*").alias("rows"), F.sum(L.LABEL).alias("positives")).first()
            progress.append({"cap": cap, "training_rows": size.rows, "training_positives": size.positives, **found})
        candidates = [{**progress[-1], "model": BASELINE}]
        candidates += [_measured(fit[kind](last), part["validation"], kind, folder) for kind in kinds if kind != BASELINE]
        compared = spark.createDataFrame([(c["model"], c["roc_auc"], c["average_precision"]) for c in candidates], "model string, roc_auc double, average_precision double")
        selected = L.select_model(compared, BASELINE).first().selected_model

        both = part["train"].unionByName(part["validation"])
        final = write_table(L.stratified_cap(both, caps[-1]), f"{folder}/final")
        model = fit[selected](final)
        test = _measured(model, part["test"], "held-out-test", folder)
        metadata = {
            "model_version": model_version, "selected_model": selected, "features": ",".join(L.FEATURES), "seed": str(L.SEED), "threshold": str(C.SCORE_THRESHOLD),
            "caps": ",".join(map(str, caps)), "selection_rows": str(progress[-1]["training_rows"]), "final_rows": str(final.count()),
            "validation_rows": str(part["validation"].count()), "test_rows": str(part["test"].count()),
            "validation_average_precision": repr(next(c for c in candidates if c["model"] == selected)["average_precision"]),
            "test_average_precision": repr(test["average_precision"]), "test_roc_auc": repr(test["roc_auc"]),
        }
        model.save(path, metadata)
        sample = write_table(part["test"].orderBy(L.GROUP, *L.IDENTITY).limit(RELOAD_ROWS), f"{folder}/sample")
        differing = model.score(sample).exceptAll(L.load_model(spark, path).score(sample)).first()
        if differing:
            raise ReloadError(f"reloaded model scores {differing.asDict()} differently")
    return TrainingResult(selected, progress, candidates, test, metadata)
