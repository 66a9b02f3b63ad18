"""The full feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.functions.dates import index_date
from riskgrid.functions.geo import KEY
from riskgrid.operators import calendar as cal
from riskgrid.operators.grid import (
    bounds_struct,
    join_calendar,
    road_cutoffs,
    with_location_id,
    with_road_type,
    with_rush_hour,
)
from riskgrid.operators.locations import (
    cell_sightings,
    clusters_of_cells,
    kmeans_clusters,
    sample_locations,
    with_cluster,
)
from riskgrid.operators.quantiles import exact_medians
from riskgrid.operators.weather import fill_with, weather_by_hour, with_severe_flag
from riskgrid.operators.windows import LABEL_HOURS, TRAILING, ahead, grid_window_counts, label_column, lag_columns
from riskgrid.session import stage

def place_hours(accidents: DataFrame) -> DataFrame:
    """Staged event counts and weather per place and hour."""
    return stage(weather_by_hour(accidents), "place-hours")


def grid_medians(hours: DataFrame) -> DataFrame:
    """Median of each weather column over the grid: a place-hour fills exactly one grid row."""
    return exact_medians(hours, [], schemas.WEATHER_COLUMNS)


def build_features(
    accidents: DataFrame,
    calendar: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
    locations: DataFrame | None = None,
    max_locations: int | None = None,
    cluster_map: DataFrame | None = None,
    cluster_method: str = "kmeans",
    cell_size: float = 1.0,
    label_hours: int = LABEL_HOURS,
) -> DataFrame:
    """One row per place, date and hour with all features and the label.

    The events are reduced to place-hours once and staged; everything after works on that table.
    ``cluster_method`` is ``kmeans`` or ``cells``; a ``cluster_map`` overrides it.
    All places are used unless ``locations`` (key columns) or ``max_locations`` narrows them.
    """
    hours = place_hours(accidents)
    if start is None or end is None:
        span = hours.agg(
            index_date(F.min("hour_idx")).alias("start_date"), index_date(F.max("hour_idx")).alias("end_date")
        )
        bounds = span.select(
            F.coalesce(F.lit(start).cast("date"), "start_date").alias("start_date"),
            F.coalesce(F.lit(end).cast("date"), "end_date").alias("end_date"),
        )
    else:
        bounds = cal.date_bounds(accidents.sparkSession, start, end)
    if cluster_map is None:
        if cluster_method == "kmeans":
            cluster_map = kmeans_clusters(accidents)
        else:
            cluster_map = clusters_of_cells(stage(cell_sightings(accidents, cell_size), "cell-sightings"))

    history = hours.groupBy(*KEY).agg(F.sum("event_count").alias("accident_freq_historical"))
    if locations is not None:
        places = locations.select(*KEY).distinct().join(history, KEY, "left")
        places = places.withColumn("accident_freq_historical", F.coalesce("accident_freq_historical", F.lit(0)))
    else:
        places = history if max_locations is None else sample_locations(history, max_locations)
    places = with_cluster(places, cluster_map)

    limits = bounds_struct(bounds)
    calendar = cal.build_calendar(bounds) if calendar is None else calendar
    calendar = calendar.where(F.col("date").between(limits["start_date"], limits["end_date"]))

    in_grid = hours.where(index_date(F.col("hour_idx")).between(limits["start_date"], limits["end_date"]))
    if locations is not None or max_locations is not None:
        near = hours.join(places.select(*KEY), KEY, "left_semi")
        in_grid = in_grid.join(places.select(*KEY), KEY, "left_semi")
    else:
        near = hours
    medians = grid_medians(in_grid)
    # Every place has the same number of grid rows, so each counts once per grid row.
    rows_per_place = (F.date_diff(limits["end_date"], limits["start_date"]) + 1) * 24
    cutoffs = road_cutoffs(places, weight=rows_per_place)

    grid = grid_window_counts(
        places, near, bounds, [*TRAILING, ahead(label_hours)], [*schemas.WEATHER_COLUMNS, "weather_condition"]
    )
    grid = with_rush_hour(join_calendar(grid, calendar))
    grid = with_severe_flag(fill_with(grid, medians))
    grid = with_location_id(with_road_type(grid, cutoffs))
    grid = grid.withColumns({**lag_columns(), schemas.TARGET: label_column()})
    return grid.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FEATURES])
