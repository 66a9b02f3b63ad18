import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.operators import grid
from riskgrid.operators import weather as wx
from riskgrid.operators.quantiles import exact_medians, exact_modes


@pytest.mark.parametrize("seed", range(6))
def test_exact_medians_of_skewed_groups(spark, seed):
    rng = random.Random(seed)
    makers = [
        lambda: rng.gauss(0, 1),
        lambda: 10.0 ** rng.uniform(-8, 8),
        lambda: float(rng.randrange(3)),
        lambda: None if rng.random() < 0.5 else rng.uniform(-1, 1),
        lambda: 7.25,
        lambda: rng.choice([0.0, 1e-12, 2e-12, 1e9]),
    ]
    make = makers[seed]
    sizes = {"hot": 30_000, "two": 2, "one": 1, "odd": 501, "even": 500}
    rows = [(k, make(), rng.random()) for k, n in sizes.items() for _ in range(n)]
    frame = spark.createDataFrame(rows, "k string, a double, b double").repartition(5)
    got = {r.k: r for r in exact_medians(frame, ["k"], ["a", "b"]).collect()}
    whole = exact_medians(frame, [], ["a", "b"]).first()

    def median(values):
        present = [v for v in values if v is not None]
        return pytest.approx(statistics.median(present), rel=1e-12) if present else None

    for k in sizes:
        assert got[k].a == median([r[1] for r in rows if r[0] == k])
        assert got[k].b == median([r[2] for r in rows if r[0] == k])
    assert (whole.a, whole.b) == (median([r[1] for r in rows]), median([r[2] for r in rows]))


def test_medians_of_many_small_groups_need_no_slices(spark):
    """Groups of two values, or of one repeated, are settled by one aggregate; the rest is not run."""
    rows = [(k, v) for k in range(300) for v in ([1.5 * k, 4.0] if k % 2 else [7.0] * 5)]
    frame = spark.createDataFrame([*rows, (-1, None)], "k int, a double").repartition(4)
    found = exact_medians(frame, ["k"], ["a"])
    assert {r.k: r.a for r in found.collect()} == {k: (1.5 * k + 4.0) / 2 if k % 2 else 7.0 for k in range(300)}
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in final and "Window" not in final and "Generate" not in final


def test_medians_of_groups_settled_and_open(spark):
    """A group with one open column goes by slices with all its columns; nulls, NaN, equal and odd counts beside it."""
    nan = float("nan")
    groups = {
        "open": [(1.0, 5.0), (2.0, 5.0), (9.0, None)], "pair": [(1.0, -2.0), (4.0, None)], "none": [(None, None)] * 4,
        "half": [(None, 1.0), (None, 2.0), (None, 4.0), (None, 8.0)], "same": [(3.0, 3.0)] * 6, "nan": [(nan, 1.0), (nan, nan), (1.0, 1.0)],
    }
    frame = spark.createDataFrame([(k, *r) for k, found in groups.items() for r in found], "k string, a double, `b c` double")
    got = {r[0]: (repr(r[1]), repr(r[2])) for r in exact_medians(frame.repartition(3), ["k"], ["a", "b c"]).collect()}
    want = {"open": (2.0, 5.0), "pair": (2.5, -2.0), "half": (None, 3.0), "same": (3.0, 3.0), "nan": (nan, 1.0)}
    assert got == {k: (repr(a), repr(b)) for k, (a, b) in want.items()}


def test_medians_beside_a_gap_stay_bounded(spark):
    """Values that lie close together beside a wide gap: slices shrink all the same, and no window is large."""
    n = 40_000
    near = [1.0 + i * 2.0**-52 for i in range(n)]
    wide = [10.0 ** (i % 300) for i in range(n // 2 - 7)]
    tiny = [5e-324 * i for i in range(n // 2 - 9)]
    special = [float("inf"), float("-inf"), 0.0, -0.0, -1e300, float("nan")]
    for values in (near + wide + special, near + tiny, [-v for v in near] + wide, special, [float("nan")] * 3 + [1.0]):
        frame = spark.createDataFrame([(v,) for v in values], "a double").repartition(6)
        got = exact_medians(frame, [], ["a"]).first().a
        want = frame.agg(F.median("a")).first()[0]
        assert got == want or (got != got and want != want)


def test_magnitude_never_falls(spark):
    from riskgrid.operators import quantiles

    rng = random.Random(4)
    values = sorted([rng.uniform(-1, 1) * 10.0 ** rng.randrange(-320, 308) for _ in range(5000)] + [2.0**k for k in range(-1074, 1024)])
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    rows = frame.select("v", quantiles._magnitude(F.col("v")).alias("m")).collect()
    rows.sort(key=lambda r: r.v)
    assert all(a.m <= b.m for a, b in zip(rows, rows[1:]))


def test_modes(spark):
    rows = [("t", "b"), ("t", "a"), ("t", "b"), ("t", "a"), ("t", None), ("n", None), ("m", "z"), ("m", None), ("m", None)]
    frame = spark.createDataFrame(rows, "k string, c string")
    assert {r.k: r.c for r in exact_modes(frame, ["k"], "c").collect()} == {"t": "a", "n": None, "m": "z"}


def accident_rows(spark, n=400):
    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        measures = [None if rng.random() < 0.3 else round(rng.uniform(0, 50), 2) for _ in schemas.WEATHER_COLUMNS]
        place = (1.0, 1.0) if i % 3 else (2.0, float(i % 4))
        condition = rng.choice(["Fog", "Clear", "Ice", None])
        rows.append((str(i), start + dt.timedelta(hours=i % 7), *place, *measures, condition))
    measures = ", ".join(f"{c} double" for c in schemas.WEATHER_COLUMNS)
    return spark.createDataFrame(
        rows,
        "accident_id string, timestamp timestamp_ntz, latitude double, longitude double, "
        f"{measures}, weather_condition string",
    )


def test_weather_equals_builtins(spark):
    accidents = accident_rows(spark)
    got = wx.weather_by_hour(accidents)
    builtin = wx.with_place_hour(accidents).groupBy(*wx.PLACE_HOUR).agg(
        F.count(F.lit(1)).alias("event_count"),
        *[F.median(c).alias(c) for c in schemas.WEATHER_COLUMNS],
        F.mode("weather_condition", True).alias("weather_condition"),
    )
    assert got.columns == builtin.columns
    assert got.exceptAll(builtin).isEmpty() and builtin.exceptAll(got).isEmpty()


def test_place_hours_without_a_place_or_with_nan(spark):
    accidents = accident_rows(spark)
    odd = accidents.withColumns(
        {"latitude": F.when(F.col("accident_id").cast("int") % 5 > 0, F.col("latitude")),
         "visibility_mi": F.when(F.col("accident_id").cast("int") % 4 > 0, F.col("visibility_mi")).otherwise(F.lit(float("nan")))}
    )
    got = wx.weather_by_hour(odd)
    builtin = wx.with_place_hour(odd).groupBy(*wx.PLACE_HOUR).agg(
        F.count(F.lit(1)).alias("event_count"),
        *[F.median(c).alias(c) for c in schemas.WEATHER_COLUMNS],
        F.mode("weather_condition", True).alias("weather_condition"),
    )
    assert got.exceptAll(builtin).isEmpty() and builtin.exceptAll(got).isEmpty()


def shape(df):
    """The operators of the plan, without sizes and numbers."""
    text = df._jdf.queryExecution().sparkPlan().toString()
    return [line.strip(" +-:").split("(")[0].split(" ")[0] for line in text.splitlines()]


def test_one_plan_for_any_share_of_a_place_hour(spark):
    """Most events in one place-hour, at two sizes: the same plan, and the built-in medians."""
    plans = []
    for n in (2_000, 60_000):
        events = spark.range(n).select(
            F.col("id").cast("string").alias("accident_id"),
            F.expr("timestamp_ntz'2024-01-01 05:00:00' + make_dt_interval(0, if(id % 10 < 8, 0, cast(id % 7 as int)), 0, 0)").alias("timestamp"),
            F.lit(1.0).alias("latitude"),
            F.when(F.col("id") % 10 < 8, 1.0).otherwise((F.col("id") % 5).cast("double")).alias("longitude"),
            *[F.when(F.col("id") % (k + 3) > 0, F.round(F.rand(k) * 500, 1)).alias(c) for k, c in enumerate(schemas.WEATHER_COLUMNS)],
            F.when(F.col("id") % 4 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("weather_condition"),
        ).cache()
        got = wx.weather_by_hour(events)
        want = wx.with_place_hour(events).groupBy(*wx.PLACE_HOUR).agg(
            F.count(F.lit(1)).alias("event_count"),
            *[F.median(c).alias(c) for c in schemas.WEATHER_COLUMNS],
            F.mode("weather_condition", True).alias("weather_condition"),
        )
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        plans.append(shape(got))
    assert plans[0] == plans[1]


def test_impute_and_severe(spark):
    frame = spark.createDataFrame(
        [(1.0, "fog"), (None, "Thunderstorm"), (3.0, "Light Snow"), (10.0, None), (None, "Ice Pellets")],
        "temperature_f double, weather_condition string",
    )
    got = wx.with_severe_flag(wx.impute_medians(frame, ["temperature_f"])).collect()
    assert [r.temperature_f for r in got] == [1.0, 3.0, 3.0, 10.0, 3.0]
    assert [r.is_severe_weather for r in got] == [False, False, True, False, True]


def test_road_type_edges(spark):
    frame = spark.createDataFrame([(f,) for f in (1, 2, 3, 4, 5)], "accident_freq_historical bigint")
    cutoffs = grid.road_cutoffs(frame)
    assert tuple(cutoffs.first()) == (2.0, 4.0)
    got = grid.with_road_type(frame, cutoffs).orderBy("accident_freq_historical").collect()
    assert [r.road_type for r in got] == ["residential", "arterial", "arterial", "arterial", "highway"]


def test_road_cutoffs_count_each_place_once_per_grid_row(spark):
    places = spark.createDataFrame([(f,) for f in (1, 2, 10, 11)], "accident_freq_historical bigint")
    copies = places.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(48)))).drop("i")
    weighted = grid.road_cutoffs(places, weight=F.lit(48)).first()
    assert weighted == grid.road_cutoffs(copies).first()
