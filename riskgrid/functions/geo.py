"""Location keys, points and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: places are told apart to four decimals of a degree.
KEY_SCALE = 10000

KEY = ["lat_e4", "lon_e4"]


def degree_key(degrees: Column) -> Column:
    """Degrees x 10^4 as bigint, ties to even: an exact join key instead of a float."""
    return F.rint(degrees * F.lit(float(KEY_SCALE))).cast("bigint")


def key_degrees(key: Column) -> Column:
    return key / F.lit(float(KEY_SCALE))


def with_location_key(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    return df.withColumns({"lat_e4": degree_key(F.col(latitude)), "lon_e4": degree_key(F.col(longitude))})


def location_id(latitude: Column, longitude: Column) -> Column:
    return F.concat_ws("_", latitude.cast("string"), longitude.cast("string"))


def point(longitude: Column, latitude: Column, srid: int = 4326) -> Column:
    return F.struct(
        longitude.cast("double").alias("lon"),
        latitude.cast("double").alias("lat"),
        F.lit(srid).alias("srid"),
    )


def cell(degrees: Column, size: float) -> Column:
    """Index of the square cell of ``size`` degrees that holds ``degrees``."""
    return F.floor(degrees / F.lit(float(size)))
