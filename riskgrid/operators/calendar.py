"""Calendar dimension: one row per day, with date parts and US holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default start and end of the calendar.
DEFAULT_START = "2016-01-01"
DEFAULT_END = "2024-12-31"

# Holidays on a fixed day (month, day, first year).
FIXED_HOLIDAYS = {
    "New Year's Day": (1, 1, 1870),
    "Juneteenth National Independence Day": (6, 19, 2021),
    "Independence Day": (7, 4, 1870),
    "Veterans Day": (11, 11, 1938),
    "Christmas Day": (12, 25, 1870),
}
# Holidays on the first given weekday on or after a day (month, day, weekday, first year).
FLOATING_HOLIDAYS = {
    "Martin Luther King Jr. Day": (1, 15, "MON", 1986),
    "Washington's Birthday": (2, 15, "MON", 1971),
    "Memorial Day": (5, 25, "MON", 1971),
    "Labor Day": (9, 1, "MON", 1894),
    "Columbus Day": (10, 8, "MON", 1971),
    "Thanksgiving": (11, 22, "THU", 1942),
}
OBSERVED = " (Observed)"


def date_bounds(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """One row ``start_date, end_date``."""
    day = lambda text: F.lit(text).cast("date")
    return spark.range(1).select(day(start).alias("start_date"), day(end).alias("end_date"))


def column_bounds(df: DataFrame, column: str) -> DataFrame:
    """One row with the first and last date found in ``column``."""
    day = F.to_date(F.col(column))
    return df.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every date from ``start_date`` to ``end_date``, both included."""
    return bounds.select(F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("date"))


def with_date_parts(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            "day_of_week": F.weekday(day),
            "day_name": F.date_format(day, "EEEE"),
            "is_weekend": F.weekday(day).isin(5, 6),
            "quarter": F.quarter(day),
            "week_of_year": F.weekofyear(day),
        }
    )


def holidays(bounds: DataFrame) -> DataFrame:
    """Holiday dates and names of every year the bounds touch: at most 16 rows per year.

    A fixed holiday on Saturday is also observed on Friday, one on Sunday on Monday. The year
    after the end counts too, because its first day may be observed on 31 December.
    """

    def entry(date: str, name: str, first_year: int) -> str:
        quoted = name.replace("'", "\\'")
        return f"struct(if(year >= {first_year}, {date}, null) as date, '{quoted}' as holiday_name)"

    entries = []
    for name, (month, day, first_year) in FIXED_HOLIDAYS.items():
        date = f"make_date(year, {month}, {day})"
        observed = f"case weekday({date}) when 5 then {date} - 1 when 6 then {date} + 1 end"
        entries += [entry(date, name, first_year), entry(observed, name + OBSERVED, first_year)]
    for name, (month, day, weekday, first_year) in FLOATING_HOLIDAYS.items():
        entries.append(entry(f"next_day(make_date(year, {month}, {day}) - 1, '{weekday}')", name, first_year))
    years = bounds.select(F.explode(F.sequence(F.year("start_date"), F.year("end_date") + 1)).alias("year"))
    return years.select(F.expr(f"inline(array({', '.join(entries)}))")).where(F.col("date").isNotNull())


def with_holidays(days: DataFrame, holiday_table: DataFrame) -> DataFrame:
    """Holiday flag and name. The holiday table is broadcast: a few rows per year."""
    joined = days.join(F.broadcast(holiday_table), "date", "left")
    return joined.withColumn("is_holiday", F.col("holiday_name").isNotNull())


def build_calendar(bounds: DataFrame) -> DataFrame:
    days = with_holidays(with_date_parts(date_spine(bounds)), holidays(bounds))
    return days.select(
        "date", "year", "month", "day", "day_of_week", "day_name",
        "is_weekend", "is_holiday", "holiday_name", "quarter", "week_of_year",
    )
