"""Raw files to predictions, step by step or in one call."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.functions.risk import HIGH_RISK, MEDIUM_RISK
from riskgrid.operators.calendar import DEFAULT_START, build_calendar, date_bounds
from riskgrid.operators.cleaning import clean_counted, to_table_columns
from riskgrid.operators.sampling import NEGATIVE_CAP, POSITIVE_CAP
from riskgrid.operators.training import DEFAULT_MODELS, ModelSpec
from riskgrid.plans.features import build_features
from riskgrid.plans.score import score_day
from riskgrid.plans.train import train_models
from riskgrid.session import own_session
from riskgrid.sources.models import load_recorded
from riskgrid.sources.scans import csv_events, parquet_table
from riskgrid.sources.sinks import (
    first_by_key,
    insert_ignore,
    truncate_and_load,
    with_point,
    write_features,
    write_table,
)

STEPS = ["ingestion", "features", "training", "prediction", "all"]


@dataclass(frozen=True)
class Project:
    """Where the tables live and what to run. Dates are explicit; nothing reads the clock."""

    root: str
    raw_path: str
    prediction_date: str
    version: str
    run_time: str
    calendar_start: str = DEFAULT_START
    calendar_end: str | None = None
    model_name: str = "xgboost"
    # The version to predict with; None: the one trained last.
    model_version: str | None = None
    specs: Sequence[ModelSpec] = tuple(DEFAULT_MODELS)
    write_policy: str = "append"
    output_format: str = "csv"
    feature_options: dict[str, Any] = field(default_factory=dict)
    # Bounds on the labelled rows that models are fitted on.
    positives: int = POSITIVE_CAP
    negatives: int = NEGATIVE_CAP
    # Limits of the risk categories.
    medium_risk: float = MEDIUM_RISK
    high_risk: float = HIGH_RISK

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def ingest(spark: SparkSession, project: Project) -> dict[str, int]:
    """Clean the raw files into the event table and load the calendar.

    Returns how many raw rows there were, how many were kept and how many the cleaning removed, counted while the event
    table was written (zeros if the policy left the table alone): the raw files are read once.
    """
    cleaned, counts = clean_counted(csv_events(own_session(spark), project.raw_path))
    events = with_point(to_table_columns(cleaned))
    written = True
    if project.write_policy == "append":
        insert_ignore(events, project.path("accidents"))
    else:
        written = write_table(first_by_key(events), project.path("accidents"), project.write_policy)
    stored = parquet_table(spark, project.path("accidents"), schemas.ACCIDENTS)
    seen = stored.agg(F.to_date(F.min("timestamp")), F.to_date(F.max("timestamp"))).first()
    asked = [dt.date.fromisoformat(d) for d in (project.calendar_start, project.calendar_end or project.prediction_date)]
    # The calendar covers every event, whatever was asked for: a day without it would have null features.
    first, last = min([asked[0], *seen[:1]] if seen[0] else asked[:1]), max([asked[1], *seen[1:]] if seen[1] else asked[1:])
    days = build_calendar(date_bounds(spark, first.isoformat(), last.isoformat()))
    truncate_and_load(days, project.path("calendar"))
    return counts() if written else dict.fromkeys(("rows_in", "rows_kept", "rows_removed"), 0)


def build(spark: SparkSession, project: Project) -> None:
    # The full schema: columns the raw files lack are read as null.
    accidents = parquet_table(spark, project.path("accidents"), schemas.ACCIDENTS)
    calendar = parquet_table(spark, project.path("calendar"))
    days = calendar.agg(F.min("date"), F.max("date")).first()
    seen = accidents.agg(F.to_date(F.min("timestamp")), F.to_date(F.max("timestamp"))).first()
    if seen[0] and not (days[0] and days[0] <= seen[0] and seen[1] <= days[1]):
        raise ValueError(f"the calendar covers {days[0]} to {days[1]}, the events {seen[0]} to {seen[1]}")
    features = build_features(accidents, calendar, **project.feature_options)
    write_features(features, project.path("features_daily"))


def train(spark: SparkSession, project: Project) -> DataFrame:
    """Train all specs and return their metrics."""
    features = parquet_table(spark, project.path("features_daily"))
    _, report = train_models(
        features, project.version, project.run_time, project.specs,
        project.path("models"), project.path("model_metadata"), project.positives, project.negatives,
    )
    return report


def predict(spark: SparkSession, project: Project) -> DataFrame:
    """Score the prediction date with the stored model that the metadata names; returns the highest-risk zones."""
    metadata = parquet_table(spark, project.path("model_metadata"), schemas.MODEL_METADATA)
    trained = load_recorded(spark, metadata, project.model_name, project.model_version)
    features = parquet_table(spark, project.path("features_daily"))
    return score_day(
        features, trained, project.prediction_date, project.path("predictions"),
        project.path("prediction_files"), project.output_format,
        medium_risk=project.medium_risk, high_risk=project.high_risk,
    )


def run(
    spark: SparkSession, project: Project, step: str = "all", skip_ingestion: bool = False,
    skip_training: bool = False,
) -> DataFrame | None:
    """One step, or all of them with ingestion or training left out. Steps meet only in stored tables."""
    if step not in STEPS:
        raise ValueError(f"step must be one of {STEPS}, not {step!r}")
    everything = step == "all"
    if step == "ingestion" or (everything and not skip_ingestion):
        ingest(spark, project)
    if step == "features" or everything:
        build(spark, project)
    if step == "training" or (everything and not skip_training):
        report = train(spark, project)
        if not everything:
            return report
    if step == "prediction" or everything:
        return predict(spark, project)
    return None
