"""Class-capped samples, exact splits and undersampling, repeatable and without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.operators.ranking import cut_by_hash, text_hash
from riskgrid.schemas import TABLE_KEYS, TARGET

# Class caps of the training sample and cumulative shares of the split.
POSITIVE_CAP = 50_000
NEGATIVE_CAP = 200_000
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.85

FEATURE_KEY = TABLE_KEYS["features_daily"]


def class_sample(df: DataFrame, label: str, value: int, cap: int, key: Sequence[str] = FEATURE_KEY) -> DataFrame:
    """At most ``cap`` random rows of one class."""
    rows = df.where(F.col(label) == value)
    return cut_by_hash(rows, label, key, [F.lit(cap)]).where("segment = 0").drop("segment")


def training_sample(
    df: DataFrame,
    label: str = TARGET,
    positives: int = POSITIVE_CAP,
    negatives: int = NEGATIVE_CAP,
    key: Sequence[str] = FEATURE_KEY,
) -> DataFrame:
    """Capped positives and capped negatives, cut in one pass. Rows of other labels are left out."""
    cap = F.when(F.col("_group") == 1, F.lit(positives)).otherwise(F.lit(negatives))
    rows = df.where(F.col(label).isin(0, 1))
    return cut_by_hash(rows, label, key, [cap]).where("segment = 0").drop("segment")


def shuffled(df: DataFrame, key: Sequence[str] = FEATURE_KEY) -> DataFrame:
    """Rows in a repeatable random order, for consumers that care about order."""
    return df.orderBy(text_hash(key), *key)


def stratified_split(
    df: DataFrame,
    label: str = TARGET,
    key: Sequence[str] = FEATURE_KEY,
    train: float = TRAIN_SHARE,
    validation: float = VALIDATION_SHARE,
) -> DataFrame:
    """Column ``split``: train, val or test, with exact shares within each class."""
    cuts = [F.floor(F.col("group_rows") * F.lit(share)) for share in (train, validation)]
    segment = F.col("segment")
    name = F.when(segment == 0, "train").when(segment == 1, "val").otherwise("test")
    return cut_by_hash(df, label, key, cuts).withColumn("split", name).drop("segment")


def bounded_split(
    df: DataFrame,
    label: str = TARGET,
    positives: int = POSITIVE_CAP,
    negatives: int = NEGATIVE_CAP,
    key: Sequence[str] = FEATURE_KEY,
) -> DataFrame:
    """``stratified_split`` of all labelled rows, of whose train rows at most so many of each class stay; one pass."""
    cap = F.when(F.col("_group") == 1, F.lit(positives)).otherwise(F.lit(negatives))
    train, validation = (F.floor(F.col("group_rows") * F.lit(share)) for share in (TRAIN_SHARE, VALIDATION_SHARE))
    cut = cut_by_hash(df.where(F.col(label).isin(0, 1)), label, key, [F.least(cap, train), train, validation])
    segment = F.col("segment")
    name = F.when(segment == 0, "train").when(segment == 2, "val").otherwise("test")
    return cut.where(segment != 1).withColumn("split", name).drop("segment")


def time_split(df: DataFrame, train_end: str, val_end: str, test_end: str, date: str = "feature_date") -> DataFrame:
    """Column ``split`` by three last dates; rows after the last one are dropped."""
    day = F.col(date)
    until = lambda text: day <= F.lit(text).cast("date")
    name = F.when(until(train_end), "train").when(until(val_end), "val").otherwise("test")
    return df.where(until(test_end)).withColumn("split", name)


def split_summary(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("positive_rate"))


def undersample(df: DataFrame, label: str = TARGET, key: Sequence[str] = FEATURE_KEY) -> DataFrame:
    """Every class cut at random to the size of the smallest."""
    return cut_by_hash(df, label, key, [F.col("smallest_group")]).where("segment = 0").drop("segment")


def balanced_weight(df: DataFrame, label: str = TARGET) -> Column:
    """Weight n / (2 x rows of the class), so that both classes weigh the same; null for a null label."""
    totals = df.agg(F.struct(F.count(label).alias("rows"), F.sum(label).alias("positives"))).scalar()
    positive = F.col(label) == 1
    of_class = F.when(positive, totals["positives"]).when(~positive, totals["rows"] - totals["positives"])
    return totals["rows"] / (F.lit(2.0) * of_class)


def with_balanced_weight(df: DataFrame, label: str = TARGET, out: str = "weight") -> DataFrame:
    return df.withColumn(out, balanced_weight(df, label))


def with_positive_weight(df: DataFrame, weight: float, label: str = TARGET, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, float(weight)).otherwise(1.0))
