"""Sinks: Parquet folders as tables, written only through Spark's commit protocol."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.functions.geo import point
from riskgrid.session import partition_bytes

# Answers to "the target already has rows".
WRITE_POLICIES = ["append", "replace", "cancel", "fail"]

# Bytes, as sent, of feature rows that a task sorts and writes: about half a million rows.
FEATURE_BYTES = "16m"
FEATURE_ROWS = 1 << 19
PLACE_FILTER = {"parquet.bloom.filter.enabled#location_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def with_point(df: DataFrame) -> DataFrame:
    return df.withColumn("location", point(F.col("longitude"), F.col("latitude")))


def first_by_key(df: DataFrame, key: str = "accident_id", order: str = "timestamp") -> DataFrame:
    """Earliest row per key. A minimum, so copies of one key are reduced before the shuffle.

    Rows equal in ``order`` are told apart by their other columns.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    first = df.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_row"))
    return first.select(*[key if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def new_rows(
    incoming: DataFrame, existing: DataFrame | None, key: str = "accident_id", order: str = "timestamp"
) -> DataFrame:
    """Rows an insert that ignores conflicts would add: first per key, key not in the table yet."""
    first = first_by_key(incoming, key, order)
    return first if existing is None else first.join(existing.select(key), key, "left_anti").select(*first.columns)


def insert_ignore(incoming: DataFrame, path: str, key: str = "accident_id", order: str = "timestamp") -> None:
    """Append the new rows only. Running it again with the same rows adds nothing."""
    existing = read_if_exists(incoming.sparkSession, path)
    new_rows(incoming, existing, key, order).write.mode("append").parquet(path)


def write_table(df: DataFrame, path: str, policy: str = "append", partition_by: Sequence[str] = ()) -> bool:
    """Write under a policy for a target that already has rows: append, replace, cancel or fail.

    A missing or empty target is written under any policy. Tells whether it wrote.
    """
    if policy not in WRITE_POLICIES:
        raise ValueError(f"policy must be one of {sorted(WRITE_POLICIES)}, not {policy!r}")
    existing = read_if_exists(df.sparkSession, path) if policy in ("cancel", "fail") else None
    if existing is not None and not existing.isEmpty():
        if policy == "fail":
            raise FileExistsError(f"{path} already has rows")
        return False
    writer = _by_partition(df, partition_by).write.mode("overwrite" if policy == "replace" else "append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return True


def truncate(spark: SparkSession, path: str) -> None:
    """Empty a table, keeping its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Replace a table. Like every overwrite of a folder this first removes the old rows: if the job
    fails, load again from the source. Readers that need the old rows meanwhile keep a copy."""
    df.write.mode("overwrite").parquet(path)


def append_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Bulk append as CSV, by default without header."""
    df.write.mode("append").option("header", header).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A short report, such as the importance of each feature, as one CSV file in its own order."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _by_partition(df: DataFrame, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Gather each partition value in few tasks, large values in several: no flood of small files.

    ``order`` sorts the rows of a file, so that a lookup by its first column skips row groups. The
    writer sorts by partition value in any case.
    """
    gathered = df.hint("rebalance", *columns) if columns else df
    return gathered.sortWithinPartitions(*columns, *order) if order else gathered


def write_features(features: DataFrame, path: str, mode: str = "overwrite", rows: int | None = None) -> None:
    """Feature table partitioned by date, so that scoring a day reads a day.

    Its rows shrink to a few bytes on the way and are sorted at full size, so a task gets few bytes of them. Adaptive
    execution parts a date only by the tasks that its rows come from. Where few tasks hold a whole date each, as when a
    stored table is copied, give the number of ``rows``: tasks then get equal ranges of dates and places.
    """
    order = ["feature_date", "location_id", "hour"]
    if rows is None:
        rows = _by_partition(features, order[:1], order[1:])
    else:
        rows = features.repartitionByRange(max(1, -(-rows // FEATURE_ROWS)), *order).sortWithinPartitions(*order)
    with partition_bytes(features.sparkSession, FEATURE_BYTES):
        rows.write.mode(mode).partitionBy("feature_date").parquet(path)


def replace_days(predictions: DataFrame, path: str, column: str = "prediction_date") -> None:
    """Replace the days present in ``predictions``; other days stay. An empty frame changes nothing.

    Rows lie by place, and every row group has a Bloom filter of its places: looking up one place over all days reads
    only the row groups that hold it.
    """
    rows = _by_partition(predictions, [column], ["location_id"])
    writer = rows.write.mode("overwrite").partitionBy(column).options(**PLACE_FILTER)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_prediction_files(predictions: DataFrame, path: str, output_format: str = "csv") -> None:
    """Export by date as CSV (without the feature documents) or Parquet; the given days are replaced."""
    if output_format not in ("csv", "parquet"):
        raise ValueError(f"output_format must be csv or parquet, not {output_format!r}")
    rows = predictions.drop("features") if output_format == "csv" else predictions
    writer = _by_partition(rows, ["prediction_date"]).write.mode("overwrite").partitionBy("prediction_date")
    writer = writer.option("partitionOverwriteMode", "dynamic").option("header", True)
    writer.format(output_format).save(path)


def metadata_row(
    spark: SparkSession, model_name: str, version: str, trained_at: str, metrics: Mapping[str, float],
    features: Sequence[str], samples: Mapping[str, int] | None = None,
    hyperparameters: Mapping[str, Any] | None = None, model_path: str | None = None, model_type: str | None = None,
) -> DataFrame:
    """One row of model metadata; absent metrics are 0. The run time is passed in."""
    samples = samples or {}
    values = {
        "model_name": model_name,
        "model_version": version,
        "model_type": model_type or model_name,
        **{f"{m}_score": float(metrics.get(m) or 0.0) for m in ("auc", "precision", "recall", "f1", "accuracy")},
        **{f"{split}_samples": samples.get(split) for split in ("train", "val", "test")},
        "features_used": list(features),
        "hyperparameters": json.dumps(dict(hyperparameters or {}), sort_keys=True),
        "model_path": model_path,
        "is_production": False,
    }
    columns = schemas.MODEL_METADATA
    row = [values.get(f.name) for f in columns]
    frame = spark.createDataFrame([row], columns)
    return frame.withColumn("training_date", F.lit(trained_at).cast("timestamp_ntz"))


def append_metadata(row: DataFrame, path: str) -> None:
    """Add rows whose (model_name, model_version) is not in the table yet; others are left out."""
    existing = read_if_exists(row.sparkSession, path)
    key = schemas.TABLE_KEYS["model_metadata"]
    new = row if existing is None else row.join(existing.select(*key), key, "left_anti").select(*row.columns)
    new.write.mode("append").parquet(path)
