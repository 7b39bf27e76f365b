"""Scoring job: held-out rows scored by a stored model, predictions upserted and reconciled."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import contracts as C
from riskmart.operators import ml as L
from riskmart.sources.keyed_table import KeyedTable
from riskmart.sources.tables import work_folder, write_table

PREDICTION_SCHEMA = (
    "source_file string, source_version string, source_row_number bigint, record_hash string, population string, model_version string, "
    "score decimal(12,10), threshold decimal(5,4), predicted_claim boolean, run_id string"
)


class ScoringError(RuntimeError):
    """The model is not the one that was asked for, or stored predictions do not match the scored rows."""


@dataclass(frozen=True)
class ScoringResult:
    run_id: str
    population: str
    model_version: str
    expected_rows: int
    predicted_rows: int
    stored_rows: int
    duplicate_identities: int
    threshold: float
    state: int


def prediction_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, root, L.PREDICTION_KEY, PREDICTION_SCHEMA, buckets, hex_columns=(L.GROUP,))


def score_population(
    spark: SparkSession, root: str, model_path: str, rows: DataFrame, population: str, model_version: str,
    threshold: float = C.SCORE_THRESHOLD, run_id: str | None = None, buckets: int = 64,
) -> ScoringResult:
    """Scores ``rows`` and publishes their predictions; running it again replaces them and adds none.

    Raises ScoringError if the stored model has another version, or if the predictions stored for this population and version are not those of
    ``rows`` one to one. Duplicate identities among the rows raise before anything is published.
    """
    metadata = L.model_metadata(spark, model_path)
    if metadata.get("model_version") != model_version:
        raise ScoringError(f"model at {model_path} has version {metadata.get('model_version')!r}, not {model_version!r}")
    run_id, table = run_id or str(uuid.uuid4()), prediction_table(spark, root, buckets)
    with work_folder(spark, "scoring") as folder:
        scored = write_table(L.predictions(L.load_model(spark, model_path).score(rows), population, model_version, run_id, threshold), f"{folder}/scored")
        predicted, expected = scored.count(), rows.count()
        if predicted != expected:
            raise ScoringError(f"{predicted} scores of {expected} rows")
        state = table.upsert(scored)
        stored = table.read(state).where((F.col("population") == population) & (F.col("model_version") == model_version))
        checked = L.require_predictions(stored, rows)
    return ScoringResult(run_id, population, model_version, expected, predicted, checked.stored_rows, checked.duplicate_identities, threshold, state)
