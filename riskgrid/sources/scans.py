"""Scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskgrid import schemas

# Cell texts that a raw file uses for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def csv_events(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
    missing: Sequence[str] = MISSING_TEXTS, multi_line: bool = False,
) -> DataFrame:
    """Raw events from CSV files with a header, every column as text, missing-value texts as null.

    Without ``columns`` the header names the columns and only the first line is read for it. Given
    columns must be the file's columns in order. A missing path is Spark's own error.
    ``multi_line`` allows line breaks in quoted cells, at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns])).option(
            "enforceSchema", False
        )
    raw = reader.csv(path)
    quoted = {c: F.col(f"`{c}`") for c in raw.columns}
    return raw.select([F.when(~c.isin(list(missing)), c).alias(name) for name, c in quoted.items()])


def parquet_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def event_scan(accidents: DataFrame) -> DataFrame:
    """The columns the feature build needs, by time; the id orders equal times."""
    return accidents.select(*schemas.EVENT_COLUMNS).orderBy("timestamp", "accident_id")


def event_scan_summary(accidents: DataFrame) -> DataFrame:
    return accidents.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )


def calendar_scan(calendar: DataFrame) -> DataFrame:
    return calendar.orderBy("date")


def read_sql(
    spark: SparkSession, query: str, params: Mapping[str, Any] | Sequence[Any] | None = None, **tables: DataFrame
) -> DataFrame:
    """SQL text with named (``:name``) or positional (``?``) parameters over frames named in braces."""
    return spark.sql(query, args=params or None, **tables)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_facts(df: DataFrame, date_column: str = "timestamp") -> DataFrame:
    """Row count and latest date as text, null for an empty table."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.date_format(F.max(date_column), "yyyy-MM-dd").alias("latest_date"),
    )


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; empty for a valid table."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
