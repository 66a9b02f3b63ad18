"""Predictions from scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.risk import HIGH_RISK, MEDIUM_RISK, as_json, risk_category
from riskgrid.operators.encoding import CATEGORICAL, align_features, assemble, one_hot

# Fixed value: default length of the list of risk zones.
TOP_ZONES = 10


def day_rows(features: DataFrame, date: str, hours: Sequence[int] | None = None) -> DataFrame:
    """Feature rows of one day, all hours or some. The date prunes table partitions."""
    day = features.where(F.col("feature_date") == F.lit(date).cast("date"))
    return day if hours is None else day.where(F.col("hour").isin(list(hours)))


def features_for_day(features: DataFrame, date: str, hours: Sequence[int] | None = None) -> DataFrame:
    return day_rows(features, date, hours).orderBy("location_id", "hour")


def prepare_features(df: DataFrame, names: Sequence[str], categories: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One-hot with the training vocabulary, then exactly the training features."""
    encoded = one_hot(df, categories) if CATEGORICAL in df.columns else df
    return align_features(encoded, names, keep)


def score(model, df: DataFrame, names: Sequence[str], out: str = "risk_score") -> DataFrame:
    """Probability of class 1 from a fitted classifier."""
    scored = model.transform(assemble(df, names))
    probability = vector_to_array("probability")[1]
    return scored.select(*df.columns, probability.alias(out))


def as_predictions(
    scored: DataFrame, version: str | None = None, feature_names: Sequence[str] | None = None,
    medium: float = MEDIUM_RISK, high: float = HIGH_RISK,
) -> DataFrame:
    """Scored feature rows -> prediction rows, the features as JSON if names are given."""
    document = as_json(feature_names) if feature_names else F.lit(None).cast("string")
    return scored.select(
        F.col("feature_date").alias("prediction_date"),
        F.col("hour").alias("prediction_hour"),
        "location_id",
        "latitude",
        "longitude",
        "risk_score",
        risk_category(F.col("risk_score"), medium, high).alias("risk_category"),
        (F.lit(version) if version is not None else F.col("model_version")).alias("model_version"),
        document.alias("features"),
    )


def category_counts(predictions: DataFrame) -> DataFrame:
    category = F.col("risk_category")
    return predictions.agg(
        F.count_if(category == "High").alias("high"),
        F.count_if(category == "Medium").alias("medium"),
        F.count_if(category == "Low").alias("low"),
    )


def high_risk_zones(predictions: DataFrame, top_n: int = TOP_ZONES) -> DataFrame:
    """The ``top_n`` highest scores among rows of category High."""
    high = predictions.where(F.col("risk_category") == "High")
    order = [F.desc("risk_score"), "location_id", "prediction_date", "prediction_hour"]
    return high.orderBy(*order).limit(top_n)


def latest_metadata(metadata: DataFrame, model_name: str | None = None) -> DataFrame:
    """Newest metadata row of one model, or of every model; the higher version wins a tie."""
    if model_name is not None:
        rows = metadata.where(F.col("model_name") == model_name)
        return rows.orderBy(F.desc("training_date"), F.desc("model_version")).limit(1)
    rest = [c for c in metadata.columns if c not in ("model_name", "training_date", "model_version")]
    newest = F.max_by(F.struct("*"), F.struct("training_date", "model_version"))
    return metadata.groupBy("model_name").agg(newest.alias("_row")).select(
        "model_name", "_row.model_version", "_row.training_date", *[f"_row.{c}" for c in rest]
    )
