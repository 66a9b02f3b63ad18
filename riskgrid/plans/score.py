"""Score one day and store the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from riskgrid.functions.risk import HIGH_RISK, MEDIUM_RISK
from riskgrid.operators.scoring import (
    TOP_ZONES,
    as_predictions,
    day_rows,
    high_risk_zones,
    prepare_features,
    score,
)
from riskgrid.session import stage
from riskgrid.sources.models import TrainedModel
from riskgrid.sources.sinks import replace_days, write_prediction_files

PLACE = ["feature_date", "hour", "location_id", "latitude", "longitude"]


def day_predictions(
    features: DataFrame, trained: TrainedModel, date: str, hours: Sequence[int] | None = None,
    include_features: bool = False, medium_risk: float = MEDIUM_RISK, high_risk: float = HIGH_RISK,
) -> DataFrame:
    return predictions_of(day_rows(features, date, hours), trained, include_features, medium_risk, high_risk)


def predictions_of(
    rows: DataFrame, trained: TrainedModel, include_features: bool = False,
    medium_risk: float = MEDIUM_RISK, high_risk: float = HIGH_RISK,
) -> DataFrame:
    """Predictions for any feature rows."""
    keep = [f"_{c}" if c in trained.features else c for c in PLACE]
    renamed = rows.withColumns({k: rows[c] for k, c in zip(keep, PLACE) if k != c})
    prepared = prepare_features(renamed, trained.features, trained.categories, keep)
    scored = score(trained.model, prepared, trained.features)
    # The feature "hour" is a number for the model; the prediction's hour is the row's own.
    restored = scored.withColumns({c: scored[k] for k, c in zip(keep, PLACE) if k != c})
    documents = trained.features if include_features else None
    return as_predictions(restored, trained.version, documents, medium_risk, high_risk)


def score_day(
    features: DataFrame, trained: TrainedModel, date: str, table_path: str | None = None,
    file_path: str | None = None, output_format: str = "csv", top_n: int = TOP_ZONES,
    include_features: bool = False, medium_risk: float = MEDIUM_RISK, high_risk: float = HIGH_RISK,
) -> DataFrame:
    """Score a day, replace it in the table, export it, and return its highest-risk zones.

    A day without feature rows writes nothing. Writes happen once: table, file and zones read the
    staged predictions.
    """
    day = day_predictions(features, trained, date, None, include_features, medium_risk, high_risk)
    predictions = stage(day, "predictions")
    if not predictions.isEmpty():
        if table_path:
            replace_days(predictions, table_path)
        if file_path:
            write_prediction_files(predictions, file_path, output_format)
    return high_risk_zones(predictions, top_n)
