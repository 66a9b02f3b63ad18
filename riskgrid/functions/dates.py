"""Wall-clock hour numbers.

Times are zone-less (``timestamp_ntz``). An hour number is days since 1970-01-01 x 24 plus the
hour of day, so neither the session zone nor daylight saving can shift a window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_index(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)


def day_hour_index(day: Column, hour: Column) -> Column:
    return F.unix_date(day).cast("bigint") * 24 + hour


def index_date(index: Column) -> Column:
    return F.date_from_unix_date(F.floor(index / F.lit(24.0)).cast("int"))


def index_hour(index: Column) -> Column:
    return F.pmod(index, F.lit(24)).cast("int")


def day_hour_timestamp(day: Column, hour: Column) -> Column:
    return F.timestamp_add("HOUR", hour, day.cast("timestamp_ntz"))
