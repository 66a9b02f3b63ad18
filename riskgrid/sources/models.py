"""Model folders: a fitted model with the feature list and vocabulary it needs."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.operators.scoring import latest_metadata


@dataclass(frozen=True)
class TrainedModel:
    name: str
    version: str
    model: object
    features: list[str]
    categories: list[str]


def version_path(root: str, name: str, version: str) -> str:
    """The folder of one version of a model: versions lie side by side."""
    return f"{root}/{name}/{version}"


def load_recorded(spark: SparkSession, metadata: DataFrame, name: str, version: str | None = None) -> TrainedModel:
    """The model that the metadata records under ``name``: ``version``, or the one trained last.

    Name, version and features are those of the metadata row; a model or version that was never recorded is an error.
    """
    rows = metadata if version is None else metadata.where(F.col("model_version") == version)
    found = latest_metadata(rows, name).select("model_version", "model_path", "features_used").first()
    if found is None or found.model_path is None:
        raise ValueError(f"no stored model {name!r}" + ("" if version is None else f" of version {version!r}"))
    stored = load_model(spark, found.model_path)
    return replace(stored, name=name, version=found.model_version, features=list(found.features_used or stored.features))


def save_model(trained: TrainedModel, path: str) -> None:
    """Write the model and its columns, replacing an older copy."""
    spark = SparkSession.active()
    # Grown trees are saved as the MLlib model they make.
    PipelineModel([getattr(trained.model, "mllib", trained.model)]).write().overwrite().save(f"{path}/model")
    columns = spark.createDataFrame(
        [(trained.name, trained.version, trained.features, trained.categories)],
        "name string, version string, features array<string>, categories array<string>",
    )
    columns.write.mode("overwrite").json(f"{path}/columns")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    """Read a model folder; a missing folder is Spark's path error."""
    fields = "name string, version string, features array<string>, categories array<string>"
    columns = spark.read.schema(fields).json(f"{path}/columns").where(F.col("name").isNotNull()).first()
    model = PipelineModel.load(f"{path}/model").stages[0]
    return TrainedModel(columns.name, columns.version, model, list(columns.features), list(columns.categories))
