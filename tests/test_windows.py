import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskgrid import session
from riskgrid.functions.geo import with_location_key
from riskgrid.operators import calendar as cal
from riskgrid.operators import grid, locations
from riskgrid.operators import weather as wx
from riskgrid.operators import windows as win

T = dt.datetime(2024, 3, 10, 5)
HOUR, MICRO = dt.timedelta(hours=1), dt.timedelta(microseconds=1)


def events(spark, times, place=(1.0, 2.0)):
    rows = [(str(i), t, *place) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "accident_id string, timestamp timestamp_ntz, latitude double, longitude double")


def counts_at(spark, times, at=T, label_hours=24):
    accidents = events(spark, times)
    hours = wx.hour_counts(accidents)
    bounds = cal.date_bounds(spark, str(at.date()), str(at.date()))
    places = locations.distinct_locations(accidents)
    made = win.grid_window_counts(places, hours, bounds, [*win.TRAILING, win.ahead(label_hours)])
    added = win.add_window_counts(grid.hourly_grid(places, bounds), hours, [*win.TRAILING, win.ahead(label_hours)])
    names = ["n_24h", "n_3d", "n_7d", "n_30d", "n_next"]
    rows = [df.where(F.col("hour") == at.hour).select(*names).collect() for df in (made, added)]
    assert rows[0] == rows[1] and len(rows[0]) == 1
    return tuple(rows[0][0])


@pytest.mark.parametrize(
    "offset, expected",
    [
        (dt.timedelta(0), (0, 0, 0, 0, 1)),
        (-MICRO, (1, 1, 1, 1, 0)),
        (-24 * HOUR, (1, 1, 1, 1, 0)),
        (-24 * HOUR - MICRO, (0, 1, 1, 1, 0)),
        (-72 * HOUR, (0, 1, 1, 1, 0)),
        (-72 * HOUR - MICRO, (0, 0, 1, 1, 0)),
        (-168 * HOUR, (0, 0, 1, 1, 0)),
        (-168 * HOUR - MICRO, (0, 0, 0, 1, 0)),
        (-720 * HOUR, (0, 0, 0, 1, 0)),
        (-720 * HOUR - MICRO, (0, 0, 0, 0, 0)),
        (24 * HOUR - MICRO, (0, 0, 0, 0, 1)),
        (24 * HOUR, (0, 0, 0, 0, 0)),
    ],
)
def test_window_edges(spark, offset, expected):
    assert counts_at(spark, [T + offset]) == expected


def test_label_window_length(spark):
    assert counts_at(spark, [T + 6 * HOUR], label_hours=6)[-1] == 0
    assert counts_at(spark, [T + 6 * HOUR - MICRO], label_hours=6)[-1] == 1


def test_random_events_against_brute_force(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    places = [(round(rng.uniform(-80, 80), 4), round(rng.uniform(-170, 170), 4)) for _ in range(4)]
    # One place holds most events, many of them in one hour.
    rows = []
    for i in range(600):
        place = places[0] if i % 3 else rng.choice(places)
        minutes = 30_000 + rng.randrange(60) if i % 5 == 0 else rng.randrange(60 * 24 * 45)
        rows.append((str(i), start + dt.timedelta(minutes=minutes), *place))
    frame = spark.createDataFrame(
        rows, "accident_id string, timestamp timestamp_ntz, latitude double, longitude double"
    )
    bounds = cal.date_bounds(spark, "2024-01-20", "2024-02-05")
    windows = [*win.TRAILING, win.ahead(24)]
    hours = wx.hour_counts(frame)
    got = win.grid_window_counts(locations.distinct_locations(frame), hours, bounds, windows)
    got = grid.with_location_id(got).collect()
    assert len(got) == len({r[2:] for r in rows}) * 17 * 24
    for g in got:
        t = dt.datetime.combine(g.feature_date, dt.time(g.hour))
        here = [r[1] for r in rows if r[2:] == (g.latitude, g.longitude)]
        want = [sum(t - n * HOUR <= e < t for e in here) for n in (24, 72, 168, 720)]
        want.append(sum(t <= e < t + 24 * HOUR for e in here))
        assert [g.n_24h, g.n_3d, g.n_7d, g.n_30d, g.n_next] == want


def test_location_key_rounds_half_to_even(spark):
    frame = spark.createDataFrame([(0.00125, -0.00005), (10.12344999, -71.00015)], "latitude double, longitude double")
    got = with_location_key(frame).collect()
    assert [(r.lat_e4, r.lon_e4) for r in got] == [(12, 0), (101234, -710002)]


def test_grid_rows_are_not_shuffled(spark):
    accidents = events(spark, [T, T + HOUR])
    bounds = cal.date_bounds(spark, "2024-03-01", "2024-03-31")
    counted = win.grid_window_counts(
        locations.distinct_locations(accidents), wx.hour_counts(accidents), bounds, win.TRAILING
    )
    plan = counted._jdf.queryExecution().executedPlan().toString()
    window = plan.index("Window")
    generate = plan.index("Generate")
    assert "Exchange" not in plan[window:generate]


def test_session_zone_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 10 March 2024 has no 02:00 to 03:00 in that zone.
        assert counts_at(spark, [T - 24 * HOUR, T - 3 * HOUR, T + 23 * HOUR]) == (2, 2, 2, 2, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tasks_of_a_larger_grid_hold_no_more_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    days = [("2024-01-01", "2024-01-02")]
    bounds = spark.createDataFrame(days, "a string, b string").selectExpr("date(a) start_date", "date(b) end_date")
    for places in (200, 400):
        keys = spark.range(places).selectExpr("cast(id * 10 as int) lat_e4", "cast(7 as int) lon_e4")
        hours = keys.selectExpr("*", "cast(473400 as bigint) hour_idx", "1L event_count")
        made = win.grid_window_counts(keys, hours, bounds, [win.ahead()])
        added = win.add_label(grid.hourly_grid(keys, bounds), hours, 6)
        for frame in (made, added):
            held = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(held) == places * 48 and max(held) <= 2_000
