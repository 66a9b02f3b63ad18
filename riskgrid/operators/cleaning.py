"""Raw text events -> typed, validated events. Every step is a map-side projection or filter."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.functions.text import lenient_boolean, lenient_double, lenient_int, lenient_timestamp

# Texts that stand for a missing time.
MISSING_TIME_TEXTS = ["NaT", "nat", "NAN"]


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def rename_columns(df: DataFrame) -> DataFrame:
    """Raw headers to table names; headers that are absent are skipped."""
    return df.withColumnsRenamed({raw: name for raw, name in schemas.RAW_COLUMNS.items() if raw in df.columns})


def require_columns(df: DataFrame) -> DataFrame:
    missing = [c for c in schemas.REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def drop_missing_required(df: DataFrame) -> DataFrame:
    return df.dropna(subset=schemas.REQUIRED_COLUMNS)


def parse_times(df: DataFrame) -> DataFrame:
    """Parse both time columns; rows whose event time cannot be read are dropped."""
    times = {c: lenient_timestamp(F.col(c)) for c in _present(df, ["timestamp", "weather_timestamp"])}
    return df.withColumns(times).where(F.col("timestamp").isNotNull())


def _on_globe() -> Column:
    return F.col("latitude").between(-90.0, 90.0) & F.col("longitude").between(-180.0, 180.0)


def keep_valid_coordinates(df: DataFrame) -> DataFrame:
    coordinates = {c: lenient_double(F.col(c)) for c in ("latitude", "longitude")}
    return df.withColumns(coordinates).where(_on_globe())


def default_flags(df: DataFrame) -> DataFrame:
    columns = _present(df, schemas.FLAG_COLUMNS)
    return df.withColumns({c: F.coalesce(lenient_boolean(F.col(c)), F.lit(False)) for c in columns})


def coerce_measures(df: DataFrame) -> DataFrame:
    return df.withColumns({c: lenient_double(F.col(c)) for c in _present(df, schemas.MEASURE_COLUMNS)})


def default_severity(df: DataFrame) -> DataFrame:
    columns = _present(df, ["severity"])
    return df.withColumns({c: F.coalesce(lenient_int(F.col(c)), F.lit(0)) for c in columns})


def normalize_texts(df: DataFrame) -> DataFrame:
    columns = _present(df, schemas.TEXT_COLUMNS)
    return df.withColumns({c: F.nullif(F.col(c).cast("string"), F.lit("nan")) for c in columns})


def sort_by_time(df: DataFrame) -> DataFrame:
    """Ordered output. The id breaks ties so that one crowded instant still spreads over ranges."""
    return df.orderBy("timestamp", "accident_id")


def clean(df: DataFrame) -> DataFrame:
    """All cleaning steps but the sort, which only an ordered result needs."""
    steps = [
        rename_columns,
        require_columns,
        drop_missing_required,
        parse_times,
        keep_valid_coordinates,
        default_flags,
        coerce_measures,
        default_severity,
        normalize_texts,
    ]
    return reduce(lambda frame, step: step(frame), steps, df)


def clean_counted(df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``clean``, and a function that tells what the first job over the result has counted on its way.

    The counts come with that job, not from another pass: raw rows, rows kept, rows removed. Asked before a job has
    run over all rows, it waits for one. Read ``df`` in ``session.own_session`` if models are fitted in the same session.
    """
    read, kept = Observation("rows read"), Observation("rows kept")
    rows = F.count(F.lit(1)).alias("rows")
    cleaned = clean(df.observe(read, rows)).observe(kept, rows)

    def counts() -> dict[str, int]:
        n, left = read.get["rows"], kept.get["rows"]
        return {"rows_in": n, "rows_kept": left, "rows_removed": n - left}

    return cleaned, counts


def to_table_columns(df: DataFrame) -> DataFrame:
    """Keep the table's columns that exist, NaN and missing-time texts as null."""

    def value(field) -> Column:
        c = F.col(field.name)
        kind = df.schema[field.name].dataType.simpleString()
        if kind in ("double", "float"):
            c = F.nanvl(c, F.lit(None).cast(kind))
        if field.name == "weather_timestamp":
            text = c.cast("string")
            c = lenient_timestamp(F.when(~text.isin(MISSING_TIME_TEXTS), text)) if kind == "string" else c
        return c.alias(field.name)

    return df.select([value(f) for f in schemas.ACCIDENTS if f.name in df.columns])


def cleaning_summary(raw: DataFrame) -> DataFrame:
    """Rows in, rows lost at each step, rows kept and their time range, in one pass."""
    named = require_columns(rename_columns(raw))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in schemas.REQUIRED_COLUMNS])
    located = (
        F.coalesce(lenient_double(F.col("latitude")).between(-90.0, 90.0), F.lit(False))
        & F.coalesce(lenient_double(F.col("longitude")).between(-180.0, 180.0), F.lit(False))
    )
    flags = named.select(
        complete.alias("complete"),
        lenient_timestamp(F.col("timestamp")).alias("time"),
        located.alias("located"),
    )
    timed = F.col("complete") & F.col("time").isNotNull()
    kept = timed & F.col("located")
    return flags.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~F.col("complete")).alias("missing_required"),
        F.count_if(F.col("complete") & F.col("time").isNull()).alias("bad_timestamp"),
        F.count_if(timed & ~F.col("located")).alias("bad_coordinates"),
        F.count_if(kept).alias("rows_kept"),
        F.min(F.when(kept, F.col("time"))).alias("first_timestamp"),
        F.max(F.when(kept, F.col("time"))).alias("last_timestamp"),
    )
