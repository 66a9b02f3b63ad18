import datetime as dt

import pytest

from riskgrid import schemas
from riskgrid.operators import cleaning
from riskgrid.sources import scans

COLUMNS = ["ID", "Start_Time", "Start_Lat", "Start_Lng", "Severity", "Junction", "City", "Humidity(%)"]


def raw(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


def row(id="a", time="2020-01-01 10:00:00", lat="10", lon="20", severity="2", junction="True", city="X", humidity="5"):
    return (id, time, lat, lon, severity, junction, city, humidity)


def kept(spark, *rows):
    return [r.accident_id for r in cleaning.clean(raw(spark, *rows)).orderBy("accident_id").collect()]


def test_globe_edges_are_kept_and_beyond_is_dropped(spark):
    rows = [
        row("a", lat="90", lon="-180"),
        row("b", lat="-90", lon="180"),
        row("c", lat="90.0001"),
        row("d", lon="-180.1"),
        row("e", lat="north"),
        row("f", lat="NaN"),
    ]
    assert kept(spark, *rows) == ["a", "b"]


@pytest.mark.parametrize(
    "text", ["2022-01-01 10:00:00", "2022-01-01 10:00:00.000000000", "2022-01-01", "2022-01-01T10:00:00.25"]
)
def test_readable_times(spark, text):
    assert kept(spark, row("a", time=text)) == ["a"]


def test_missing_or_unreadable_required_values(spark):
    rows = [row("a", time="soon"), row("b", time=None), row(None), row("c", lon=None), row("d")]
    assert kept(spark, *rows) == ["d"]


def test_defaults_and_coercions(spark):
    rows = [
        row("a", severity=None, junction=None, city="nan", humidity="NaN"),
        row("b", severity="3.9", junction="False", city="Oslo", humidity="abc"),
        row("c", severity="high", junction="maybe", city=None, humidity="7.5"),
    ]
    got = cleaning.clean(raw(spark, *rows)).orderBy("accident_id").collect()
    assert [r.severity for r in got] == [0, 3, 0]
    assert [r.junction for r in got] == [False, False, False]
    assert [r.city for r in got] == [None, "Oslo", None]
    assert [r.humidity for r in got] == [None, None, 7.5]


def test_missing_required_column(spark):
    with pytest.raises(ValueError, match="longitude"):
        cleaning.clean(raw(spark, row()).drop("Start_Lng"))


def test_table_columns(spark):
    frame = cleaning.clean(raw(spark, row())).selectExpr("*", "'NaT' as weather_timestamp", "1 as other")
    table = cleaning.to_table_columns(frame)
    assert table.columns == [f.name for f in schemas.ACCIDENTS if f.name in table.columns]
    assert "other" not in table.columns
    assert table.first().weather_timestamp is None


def test_summary_agrees_with_cleaning(spark):
    rows = [row("a"), row("b", time=None), row("c", time="x"), row("d", lat="99"), row("e", time="2021-05-05 00:00:00")]
    got = cleaning.cleaning_summary(raw(spark, *rows)).first()
    assert (got.rows_in, got.missing_required, got.bad_timestamp, got.bad_coordinates, got.rows_kept) == (5, 1, 1, 1, 2)
    assert got.first_timestamp == dt.datetime(2020, 1, 1, 10) and got.last_timestamp == dt.datetime(2021, 5, 5)
    assert got.rows_kept == cleaning.clean(raw(spark, *rows)).count()


def test_csv_missing_texts_quotes_and_schema(spark, scratch):
    lines = ['ID,Start_Time,City', '1,"2020-01-01 00:00:00","A ""B"", C"', "2,NA,null", "3,,N/A"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(scratch)
    inferred = scans.csv_events(spark, scratch).orderBy("ID").collect()
    declared = scans.csv_events(spark, scratch, ["ID", "Start_Time", "City"]).orderBy("ID").collect()
    assert inferred == declared
    assert [r.City for r in inferred] == ['A "B", C', None, None]
    assert [r.Start_Time is None for r in inferred] == [False, True, True]


def test_missing_file_is_an_error(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scans.csv_events(spark, "/nowhere/events.csv").count()
