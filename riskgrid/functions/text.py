"""Lenient casts: bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(c: Column) -> Column:
    """Number or null; NaN counts as missing."""
    return F.nanvl(c.cast("string").try_cast("double"), F.lit(None).cast("double"))


def lenient_int(c: Column) -> Column:
    """Number cut to an integer, or null."""
    return lenient_double(c).try_cast("int")


def lenient_boolean(c: Column) -> Column:
    return c.cast("string").try_cast("boolean")


def lenient_timestamp(c: Column) -> Column:
    return c.cast("string").try_cast("timestamp_ntz")
