"""Weather of a place-hour, taken from the events reported there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskgrid.functions.dates import hour_index
from riskgrid.functions.geo import KEY, with_location_key
from riskgrid.operators.quantiles import exact_medians, rows_of
from riskgrid.schemas import WEATHER_COLUMNS

PLACE_HOUR = [*KEY, "hour_idx"]

# Words that mark severe weather, case as written.
SEVERE_WORDS = ["Snow", "Heavy Rain", "Fog", "Storm", "Ice", "Sleet"]

def with_place_hour(accidents: DataFrame) -> DataFrame:
    return with_location_key(accidents).withColumn("hour_idx", hour_index(F.col("timestamp")))


def hour_counts(accidents: DataFrame) -> DataFrame:
    """Events per place and hour: at most 24 rows per place and day, however busy the place."""
    return with_place_hour(accidents).groupBy(*PLACE_HOUR).agg(F.count(F.lit(1)).alias("event_count"))


def weather_by_hour(accidents: DataFrame) -> DataFrame:
    """Event count, exact medians and most frequent condition per place and hour.

    Two levels, the same plan for any data. First one aggregate per place-hour, combined in the map tasks: how many
    values each measure has, the smallest and the largest. They settle every place-hour whose measures
    have at most two values or a single one repeated. Events of the others are counted per value
    (``_by_value``), so what is sent grows with the distinct values of a place-hour and not with its events.
    """
    events = with_place_hour(accidents).select(
        *PLACE_HOUR, *[F.col(c).cast("double").alias(c) for c in WEATHER_COLUMNS], "weather_condition"
    )
    seen = [*WEATHER_COLUMNS, "weather_condition"]
    ends = [f(c).alias(f"_{name}_{c}") for c in seen for name, f in (("n", F.count), ("low", F.min), ("high", F.max))]
    first = events.groupBy(*PLACE_HOUR).agg(F.count(F.lit(1)).alias("event_count"), *ends)
    # Null ends (no value) settle a measure too.
    mixed = [f"(_n_{c} > 2 and _low_{c} < _high_{c})" for c in seen]
    is_open = F.expr(f"event_count > 2 and coalesce({' or '.join(mixed)}, false)")
    settled = first.where(~is_open).select(
        *PLACE_HOUR,
        "event_count",
        *[((F.col(f"_low_{c}") + F.col(f"_high_{c}")) / 2).alias(c) for c in WEATHER_COLUMNS],
        F.col("_low_weather_condition").alias("weather_condition"),
    )

    return settled.unionByName(_by_value(rows_of(events, first.where(is_open), PLACE_HOUR)))


def _by_value(events: DataFrame) -> DataFrame:
    """Weather per place-hour, by counts per value. Medians are read off running counts: one measure of one place-hour is
    a window partition, which can spill."""
    condition = len(WEATHER_COLUMNS)
    measures = [f"{i}, `{c}`, cast(null as string)" for i, c in enumerate(WEATHER_COLUMNS)]
    pairs = ", ".join([*measures, f"{condition}, cast(null as double), weather_condition"])
    long = events.select(*PLACE_HOUR, F.expr(f"stack({condition + 1}, {pairs}) as (_measure, _value, _text)"))
    is_condition = F.col("_measure") == condition
    counts = long.where(is_condition | F.col("_value").isNotNull())
    counts = counts.groupBy(*PLACE_HOUR, "_measure", "_value", "_text").agg(F.count(F.lit(1)).alias("_count"))

    # One exchange by place-hour serves both windows and the aggregate after them.
    counts = counts.repartition(*PLACE_HOUR)
    values = W.partitionBy(*PLACE_HOUR, "_measure")
    upto = F.sum("_count").over(values.orderBy("_value", "_text").rowsBetween(W.unboundedPreceding, 0))
    placed = counts.withColumns({"_upto": upto, "_rows": F.sum("_count").over(values)})
    # Ranks, from 0, of the two middle values: a value holds the ranks below _upto that no smaller one holds.
    middles = [F.floor((F.col("_rows") - 1) / 2), F.floor(F.col("_rows") / 2)]
    before = F.col("_upto") - F.col("_count")
    holds = [(before <= m) & (m < F.col("_upto")) for m in middles]
    middle = lambda i, h: F.max(F.when((F.col("_measure") == i) & h, F.col("_value")))
    commonest = F.when(is_condition & F.col("_text").isNotNull(), F.struct((-F.col("_count")).alias("rank"), "_text"))
    return placed.where(is_condition | holds[0] | holds[1]).groupBy(*PLACE_HOUR).agg(
        F.sum(F.when(is_condition, F.col("_count"))).alias("event_count"),
        *[((middle(i, holds[0]) + middle(i, holds[1])) / 2).alias(c) for i, c in enumerate(WEATHER_COLUMNS)],
        F.min(commonest)["_text"].alias("weather_condition"),
    )


def join_weather(grid: DataFrame, weather: DataFrame) -> DataFrame:
    return grid.join(weather.drop("event_count"), PLACE_HOUR, "left")


def fill_with(df: DataFrame, medians: DataFrame, columns: Sequence[str] = WEATHER_COLUMNS) -> DataFrame:
    """Replace nulls by the values of the one-row frame ``medians``."""
    row = medians.select(F.struct(*columns)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), row[c]) for c in columns})


def impute_medians(df: DataFrame, columns: Sequence[str] = WEATHER_COLUMNS) -> DataFrame:
    """Replace nulls by the exact median of the column over all rows."""
    return fill_with(df, exact_medians(df, [], columns), columns)


def with_severe_flag(df: DataFrame) -> DataFrame:
    severe = F.col("weather_condition").rlike("|".join(SEVERE_WORDS))
    return df.withColumn("is_severe_weather", F.coalesce(severe, F.lit(False)))
