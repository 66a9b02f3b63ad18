"""Places: distinct keys, samples, clusters and cluster lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.dates import hour_index
from riskgrid.functions.geo import KEY, cell, degree_key, key_degrees, with_location_key
from riskgrid.operators import kmeans
from riskgrid.operators.ranking import number_by_first_seen, text_hash
from riskgrid.session import stage

# Default clusters, restarts and seed of the k-means method, size of a location sample.
CLUSTERS = 50
RESTARTS = 10
SEED = 42
SAMPLE_SIZE = 1000


def with_degrees(df: DataFrame) -> DataFrame:
    return df.withColumns({"latitude": key_degrees(F.col("lat_e4")), "longitude": key_degrees(F.col("lon_e4"))})


def location_counts(accidents: DataFrame, as_of: str | None = None) -> DataFrame:
    """Distinct places with their number of events, all of them or those before ``as_of``."""
    if as_of is not None:
        accidents = accidents.where(F.col("timestamp") < F.lit(as_of).cast("timestamp_ntz"))
    keyed = with_location_key(accidents)
    return keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("accident_freq_historical"))


def distinct_locations(accidents: DataFrame) -> DataFrame:
    return with_location_key(accidents).select(*KEY).distinct()


def sample_locations(locations: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """At most ``size`` places, the first in hash order: a repeatable random sample."""
    return locations.orderBy(text_hash(KEY), *KEY).limit(size)


def listed_locations(spark: SparkSession, places: Iterable[tuple[float, float]]) -> DataFrame:
    """Places given as (latitude, longitude) pairs."""
    frame = spark.createDataFrame(list(places), "latitude double, longitude double")
    return frame.select(degree_key(F.col("latitude")).alias("lat_e4"), degree_key(F.col("longitude")).alias("lon_e4"))


def _sightings(accidents: DataFrame, *position: Column) -> DataFrame:
    """One row per place and position, with event count, first and last time: combined before the shuffle."""
    return with_location_key(accidents).groupBy(*KEY, *position).agg(
        F.count(F.lit(1)).alias("events"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )


def last_cluster_by_location(sightings: DataFrame) -> DataFrame:
    """Cluster of the latest event at each place; the higher cluster on equal times."""
    latest = F.max_by("cluster_id", F.struct("last_seen", "cluster_id"))
    return sightings.groupBy(*KEY).agg(latest.cast("int").alias("cluster_id"))


def cell_sightings(accidents: DataFrame, size: float = 1.0) -> DataFrame:
    """Places by the square cells of ``size`` degrees they were seen in."""
    return _sightings(
        accidents,
        cell(F.col("latitude"), size).alias("cell_lat"),
        cell(F.col("longitude"), size).alias("cell_lon"),
    )


def clusters_of_cells(sightings: DataFrame) -> DataFrame:
    """Place -> cell number, cells numbered from 0 by first appearance. Reads its input three times."""
    cells = sightings.groupBy("cell_lat", "cell_lon").agg(F.min("first_seen").alias("first_seen"))
    cells = cells.withColumn("first_hour", hour_index(F.col("first_seen")))
    numbered = number_by_first_seen(cells, "first_seen", "first_hour", ["cell_lat", "cell_lon"], "cluster_id")
    named = sightings.join(numbered.select("cell_lat", "cell_lon", "cluster_id"), ["cell_lat", "cell_lon"])
    return last_cluster_by_location(named)


def cell_clusters(accidents: DataFrame, size: float = 1.0) -> DataFrame:
    return clusters_of_cells(cell_sightings(accidents, size))


def staged_positions(accidents: DataFrame) -> DataFrame:
    """Staged distinct positions of each place with their events and times; events without a position are left out."""
    events = accidents.where("latitude is not null and longitude is not null")
    return stage(_sightings(events, F.col("latitude"), F.col("longitude")), "positions")


def kmeans_clusters(
    accidents: DataFrame, clusters: int = CLUSTERS, seed: int = SEED, restarts: int = RESTARTS, max_iter: int = 300
) -> DataFrame:
    """Place -> k-means cluster, best of several seeded restarts that share their passes."""
    return kmeans_with_costs(accidents, clusters, seed, restarts, max_iter)[0]


def kmeans_with_costs(
    accidents: DataFrame, clusters: int = CLUSTERS, seed: int = SEED, restarts: int = RESTARTS, max_iter: int = 300
) -> tuple[DataFrame, kmeans.Clusters, DataFrame]:
    """``kmeans_clusters``, what the fit found, and the positions with their clusters.

    Fits on distinct positions weighted by their events, which has the same optimum as fitting on
    every event and lets one busy position count as one row. Raw events are aggregated once.
    """
    positions = staged_positions(accidents)
    found = kmeans.fit(positions.select("latitude", "longitude", "events"), clusters, seed, restarts, max_iter)
    assigned = kmeans.assign(positions, found.centres)
    return last_cluster_by_location(assigned), found, assigned


def with_cluster(df: DataFrame, cluster_map: DataFrame) -> DataFrame:
    """Cluster of the row's place, -1 where the map has none."""
    joined = df.join(cluster_map.select(*KEY, "cluster_id"), KEY, "left")
    return joined.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))


def cluster_summary(accidents: DataFrame, cluster_map: DataFrame) -> DataFrame:
    """Centre, event count and mean severity of every cluster; events are summed per place first."""
    places = with_location_key(accidents).groupBy(*KEY).agg(
        F.sum("latitude").alias("sum_lat"),
        F.sum("longitude").alias("sum_lon"),
        F.sum("severity").alias("sum_severity"),
        F.count("severity").alias("rated"),
        F.count(F.lit(1)).alias("events"),
    )
    joined = places.join(cluster_map.select(*KEY, "cluster_id"), KEY)
    return joined.groupBy("cluster_id").agg(
        (F.sum("sum_lat") / F.sum("events")).alias("centroid_latitude"),
        (F.sum("sum_lon") / F.sum("events")).alias("centroid_longitude"),
        F.sum("events").alias("accident_count"),
        F.try_divide(F.sum("sum_severity"), F.sum("rated")).alias("avg_severity"),
    )
