"""Queries over stored predictions, with the argument checks of a service."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.risk import HIGH_RISK
from riskgrid.operators.scoring import TOP_ZONES

# Largest numbers of rows that an answer may be limited to.
MAX_ROWS = 10_000
MAX_ZONES = 100

# Columns of an answer.
COLUMNS = [
    "prediction_date",
    "prediction_hour",
    "location_id",
    "latitude",
    "longitude",
    "risk_score",
    "risk_category",
    "model_version",
]


def _date(text: str):
    """The date as a column; anything but YYYY-MM-DD is a ValueError."""
    dt.datetime.strptime(text, "%Y-%m-%d")
    return F.lit(text).cast("date")


def _within(name: str, value: float, low: float, high: float) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie between {low} and {high}, not {value}")


def _rows(predictions: DataFrame) -> DataFrame:
    return predictions.select(F.col("prediction_date").cast("string").alias("prediction_date"), *COLUMNS[1:])


def predictions_by_date(predictions: DataFrame, date: str, limit: int | None = None) -> DataFrame:
    """Rows of one day, highest risk first: all of them, or ``limit``. For today's rows pass today's date."""
    if limit is not None:
        _within("limit", limit, 1, MAX_ROWS)
    day = predictions.where(F.col("prediction_date") == _date(date))
    ordered = day.orderBy(F.desc("risk_score"), "location_id", "prediction_hour")
    return _rows(ordered if limit is None else ordered.limit(limit))


def predictions_by_location(predictions: DataFrame, location_id: str, date: str | None = None) -> DataFrame:
    """Rows of one place, newest day first, then by hour; empty if the place is unknown."""
    rows = predictions.where(F.col("location_id") == location_id)
    if date is not None:
        rows = rows.where(F.col("prediction_date") == _date(date))
    return _rows(rows).orderBy(F.desc("prediction_date"), "prediction_hour")


def _risky(predictions: DataFrame, date: str, min_risk_score: float) -> DataFrame:
    _within("min_risk_score", min_risk_score, 0.0, 1.0)
    return predictions.where((F.col("prediction_date") == _date(date)) & (F.col("risk_score") >= min_risk_score))


def high_risk_zones(
    predictions: DataFrame, date: str, top_n: int = TOP_ZONES, min_risk_score: float = HIGH_RISK
) -> DataFrame:
    """The ``top_n`` rows of one day at or above a score."""
    _within("top_n", top_n, 1, MAX_ZONES)
    ordered = _risky(predictions, date, min_risk_score).orderBy(F.desc("risk_score"), "location_id", "prediction_hour")
    return _rows(ordered.limit(top_n)).drop("model_version")


def high_risk_report(
    predictions: DataFrame, date: str, top_n: int = TOP_ZONES, min_risk_score: float = HIGH_RISK
) -> DataFrame:
    """The same zones as one row: date, number of all rows at or above the score, nested list of the
    ``top_n`` (at most 100) in rank order."""
    zones = high_risk_zones(predictions, date, top_n, min_risk_score)
    rank = (-F.col("risk_score")).alias("rank")
    ranked = F.struct(rank, "location_id", "prediction_hour", F.struct(*zones.columns).alias("zone"))
    total = _risky(predictions, date, min_risk_score).agg(F.count(F.lit(1))).scalar()
    return zones.agg(F.array_sort(F.collect_list(ranked)).alias("_zones")).withColumn("total_zones", total).select(
        F.lit(date).alias("prediction_date"), "total_zones", F.col("_zones.zone").alias("zones")
    )


def statistics(predictions: DataFrame) -> DataFrame:
    """Totals by category, latest date and its model version, in one pass over the table."""
    category = F.col("risk_category")
    per_version = predictions.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(category == name).alias(name) for name in ("High", "Medium", "Low")],
        F.max("prediction_date").alias("latest"),
    )
    # On equal dates the smallest version name wins.
    newest = F.min_by("model_version", F.struct((-F.unix_date("latest")).alias("age"), "model_version"))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return per_version.agg(
        total("rows").alias("total_predictions"),
        total("High").alias("high_risk_count"),
        total("Medium").alias("medium_risk_count"),
        total("Low").alias("low_risk_count"),
        F.max("latest").cast("string").alias("latest_prediction_date"),
        newest.alias("model_version"),
    )
