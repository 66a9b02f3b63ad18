"""Event counts in sliding hour windows, past and future.

Grid times are whole hours and windows are whole numbers of hours, so a window is a range of hour
numbers. Instead of re-adding up to 720 hours for each row, every event hour is turned into the moments
at which it enters and leaves each window, and one running sum per place reads off all
windows at once: constant work per row, one sort, any window length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskgrid.functions.dates import day_hour_index, index_date, index_hour
from riskgrid.functions.geo import KEY
from riskgrid.operators.grid import bounds_struct, grid_rows
from riskgrid.schemas import TARGET, WEATHER_COLUMNS
from riskgrid.session import grid_width


@dataclass(frozen=True)
class HourWindow:
    """Hours from ``first`` to ``last`` relative to the row's hour, both included."""

    name: str
    first: int
    last: int


# Trailing windows in hours; the row's own hour is not part of them.
TRAILING = [
    HourWindow("n_24h", -24, -1),
    HourWindow("n_3d", -72, -1),
    HourWindow("n_7d", -168, -1),
    HourWindow("n_30d", -720, -1),
]
# Fixed value: hours ahead that the label looks at.
LABEL_HOURS = 24


def ahead(hours: int = LABEL_HOURS) -> HourWindow:
    return HourWindow("n_next", 0, hours - 1)


def _steps(windows: Sequence[HourWindow]) -> list[int]:
    """Offsets from an event's hour at which it enters or leaves some window."""
    return sorted({step for w in windows for step in (-w.last, 1 - w.first)})


def _change(window: HourWindow) -> Column:
    """What an event hour adds to the window's count at ``_step`` hours from it."""
    return F.expr(
        f"case _step when {-window.last} then event_count when {1 - window.first} then -event_count else 0L end"
    )


def _by_place() -> W:
    # The default range frame ends with all rows of the current hour, whatever their order.
    return W.partitionBy(*KEY).orderBy("hour_idx")


def _running_sums(windows: Sequence[HourWindow]) -> dict[str, Column]:
    return {w.name: F.sum(w.name).over(_by_place()) for w in windows}


def add_window_counts(grid: DataFrame, event_hours: DataFrame, windows: Sequence[HourWindow]) -> DataFrame:
    """Window counts for the rows of any frame that has the location key and ``hour_idx``.

    The rows are counted first (a job): so many partitions are made that a task sorts no more of a larger grid.
    """
    width = grid_width(grid.sparkSession, grid.select(*KEY).count())
    step = F.explode(F.array(*[F.lit(step) for step in _steps(windows)])).alias("_step")
    changes = event_hours.select(*KEY, F.col("hour_idx").alias("_hour"), "event_count", step)
    changes = changes.select(
        *KEY, (F.col("_hour") + F.col("_step")).alias("hour_idx"), *[_change(w).alias(w.name) for w in windows]
    )
    zero = {w.name: F.lit(0).cast("bigint") for w in windows}
    rows = grid.withColumns({**zero, "_on_grid": F.lit(True), "hour_idx": F.col("hour_idx").cast("bigint")})
    rows = rows.unionByName(changes, allowMissingColumns=True).repartition(width, *KEY)
    return rows.withColumns(_running_sums(windows)).where("_on_grid").drop("_on_grid")


def grid_window_counts(
    locations: DataFrame,
    event_hours: DataFrame,
    bounds: DataFrame,
    windows: Sequence[HourWindow],
    payload: Sequence[str] = (),
) -> DataFrame:
    """The hourly grid of ``locations`` with window counts, built without shuffling the grid.

    Places and event hours are sent to the tasks by place; grid rows and window changes are
    generated there. ``payload`` columns of ``event_hours`` land on the grid row of the same hour.
    Further columns of ``locations`` are carried along. The explicit partition number keeps
    adaptive execution from merging the small input of what grows into the whole grid; it grows with the grid, so
    that a task sorts no more of a larger one. Places are counted for it (a job).
    """
    spark = locations.sparkSession
    reach_back = max((-w.first for w in windows), default=0)
    reach_on = max((0, *(w.last for w in windows)))
    limits = bounds_struct(bounds)
    first = day_hour_index(limits["start_date"], F.lit(0))
    last = day_hour_index(limits["end_date"], F.lit(23))
    near = event_hours.where(F.col("hour_idx").between(first - reach_back, last + reach_on))
    packed = F.struct(*payload) if payload else F.lit(None)
    near = near.select(*KEY, F.col("hour_idx").alias("_hour"), "event_count", packed.alias("_payload"))
    seeds = locations.unionByName(near, allowMissingColumns=True)
    seeds = seeds.repartition(grid_width(spark, grid_rows(locations, bounds)), *KEY).withColumn("_range", limits)

    # A place becomes its days and their hours, an event hour its steps.
    days = "if(_hour is null, sequence(_range.start_date, _range.end_date), array(cast(null as date)))"
    seeds = seeds.withColumn("_day", F.expr(f"explode({days})")).drop("_range")
    steps = sorted({*_steps(windows), *([0] if payload else [])})
    hours = f"if(_hour is null, sequence(0, 23), array({', '.join(map(str, steps))}))"
    seeds = seeds.withColumn("_step", F.expr(f"explode({hours})"))

    carried = [c for c in locations.columns if c not in KEY]
    on_grid = F.col("_hour").isNull()
    origin = F.when(on_grid, day_hour_index(F.col("_day"), F.lit(0))).otherwise(F.col("_hour"))
    counts = [F.when(on_grid, F.lit(0)).otherwise(_change(w)).alias(w.name) for w in windows]
    rows = seeds.select(
        *KEY, *carried, "_hour", "_payload", (origin + F.col("_step")).alias("hour_idx"),
        on_grid.alias("_on_grid"), *counts,
    )

    computed = _running_sums(windows)
    if payload:
        # The latest event hour so far; it belongs to the grid row only if it is the row's hour.
        event = F.when(F.col("_hour") == F.col("hour_idx"), F.struct("_hour", "_payload"))
        computed["_event"] = F.last(event, ignorenulls=True).over(_by_place())
    counted = rows.withColumns(computed).where("_on_grid")
    if payload:
        same_hour = F.col("_event._hour") == F.col("hour_idx")
        counted = counted.withColumn("_payload", F.when(same_hour, F.col("_event._payload")))
    return counted.select(
        *KEY,
        *carried,
        index_date(F.col("hour_idx")).alias("feature_date"),
        index_hour(F.col("hour_idx")).alias("hour"),
        "hour_idx",
        *[w.name for w in windows],
        *[F.col("_payload")[c].alias(c) for c in payload],
    )


def grid_weather(locations: DataFrame, weather: DataFrame, bounds: DataFrame) -> DataFrame:
    """The hourly grid of ``locations`` with the weather of each place-hour, null where none is known.

    Same rows as ``join_weather`` on the made grid, but only places and place-hours are sent.
    """
    return grid_window_counts(locations, weather, bounds, [], [*WEATHER_COLUMNS, "weather_condition"])


def lag_columns() -> dict[str, Column]:
    """Lag features from the trailing counts. The seven-day count has two names in the schema."""
    return {
        "rolling_7day_accidents": F.col("n_7d").cast("int"),
        "rolling_30day_accidents": F.col("n_30d").cast("int"),
        "accidents_last_24h": F.col("n_24h").cast("int"),
        "accidents_last_7days": F.col("n_7d").cast("int"),
        "moving_avg_3day": F.col("n_3d") / F.lit(3.0),
        "moving_avg_7day": F.col("n_7d") / F.lit(7.0),
        "moving_avg_30day": F.col("n_30d") / F.lit(30.0),
    }


def label_column() -> Column:
    return (F.col("n_next") > 0).cast("int")


def add_lag_features(grid: DataFrame, event_hours: DataFrame) -> DataFrame:
    counted = add_window_counts(grid, event_hours, TRAILING)
    return counted.withColumns(lag_columns()).drop(*[w.name for w in TRAILING])


def add_label(grid: DataFrame, event_hours: DataFrame, hours: int = LABEL_HOURS) -> DataFrame:
    counted = add_window_counts(grid, event_hours, [ahead(hours)])
    return counted.withColumn(TARGET, label_column()).drop("n_next")


def label_rate(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.agg(
        F.avg(label).alias("positive_rate"),
        F.sum(label).alias("positives"),
        F.count(F.lit(1)).alias("rows"),
    )
