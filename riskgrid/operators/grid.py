"""The place x hour grid and its calendar and frequency columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.dates import day_hour_index, day_hour_timestamp
from riskgrid.functions.geo import KEY, location_id
from riskgrid.operators.locations import location_counts, with_degrees
from riskgrid.session import shuffle_width

# Hours of day that count as rush hour.
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
# Frequency quantiles between road types.
ROAD_QUANTILES = [0.25, 0.75]

CALENDAR_COLUMNS = ["day_of_week", "month", "is_weekend", "is_holiday"]


def bounds_struct(bounds: DataFrame) -> Column:
    """The one row of ``bounds`` as a scalar subquery."""
    return bounds.select(F.struct("start_date", "end_date")).scalar()


def grid_rows(locations: DataFrame, bounds: DataFrame) -> int:
    """About how many rows the hourly grid of ``locations`` has. Runs a job on its places; only sizes depend on it."""
    days = (F.date_diff("end_date", "start_date") + 1).cast("bigint")
    places = locations.agg(F.approx_count_distinct(F.struct(*KEY)).alias("places"))
    row = places.select("places", bounds.select(days).scalar().alias("days")).first()
    return row.places * (row.days or 0) * 24


def hourly_grid(locations: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every place at every hour of every day in the bounds.

    Only the places are spread over the tasks; their rows are generated where they are used, days
    first so that no array is longer than the number of days.
    """
    spread = locations.repartition(shuffle_width(locations.sparkSession))
    spread = spread.withColumn("_range", bounds_struct(bounds))
    days = spread.withColumn("feature_date", F.explode(F.sequence("_range.start_date", "_range.end_date")))
    hours = days.drop("_range").withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return hours.withColumns(
        {
            "hour_idx": day_hour_index(F.col("feature_date"), F.col("hour")),
            "feature_datetime": day_hour_timestamp(F.col("feature_date"), F.col("hour")),
        }
    )


def join_calendar(grid: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar columns by date. One row per day, so the calendar is broadcast."""
    days = calendar.select(F.col("date").alias("feature_date"), *CALENDAR_COLUMNS)
    return grid.join(F.broadcast(days), "feature_date", "left")


def with_rush_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("is_rush_hour", F.col("hour").isin(RUSH_HOURS))


def with_history(grid: DataFrame, accidents: DataFrame, as_of: str | None = None) -> DataFrame:
    """Number of events ever seen at the row's place, 0 if none."""
    joined = grid.join(location_counts(accidents, as_of), KEY, "left")
    return joined.withColumn("accident_freq_historical", F.coalesce("accident_freq_historical", F.lit(0)))


def road_cutoffs(df: DataFrame, frequency: str = "accident_freq_historical", weight: Column | None = None) -> DataFrame:
    """One row ``low, high``: the frequency quartiles over all rows, each counted ``weight`` times.

    Equal frequencies are merged first. The distinct counts of N events number less than
    sqrt(2N), about 1.4 million for 10^12 events, which is all that the last step holds.
    """
    merged = df.groupBy(frequency).agg(F.sum(F.lit(1) if weight is None else weight).alias("_rows"))
    quartiles = F.percentile(frequency, F.array(*[F.lit(q) for q in ROAD_QUANTILES]), F.col("_rows"))
    return merged.agg(quartiles.alias("_q")).select(F.col("_q")[0].alias("low"), F.col("_q")[1].alias("high"))


def with_road_type(df: DataFrame, cutoffs: DataFrame, frequency: str = "accident_freq_historical") -> DataFrame:
    """Above the upper quartile highway, from the lower quartile arterial, else residential."""
    row = cutoffs.select(F.struct("low", "high")).scalar()
    kind = (
        F.when(F.col(frequency) > row["high"], "highway")
        .when(F.col(frequency) >= row["low"], "arterial")
        .otherwise("residential")
    )
    return df.withColumn("road_type", kind)


def with_location_id(df: DataFrame) -> DataFrame:
    placed = with_degrees(df)
    return placed.withColumn("location_id", location_id(F.col("latitude"), F.col("longitude")))
