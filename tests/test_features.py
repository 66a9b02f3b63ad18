import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.operators import locations
from riskgrid.operators.weather import SEVERE_WORDS
from riskgrid.plans.features import build_features

HOUR = dt.timedelta(hours=1)
HOLIDAYS = {dt.date(2023, 12, 25), dt.date(2024, 1, 1), dt.date(2024, 1, 15)}
COLUMNS = ["accident_id", "timestamp", "latitude", "longitude", *schemas.WEATHER_COLUMNS, "weather_condition"]


def events(n=240):
    rng = random.Random(11)
    places = [(10.1234, 20.5), (10.1234, 21.5), (-33.0, 151.2), (48.85, 2.35), (48.85, 2.36)]
    rows = []
    for i in range(n):
        place = places[0] if i % 3 == 0 else rng.choice(places)
        time = dt.datetime(2024, 1, 5, 9) if i % 7 == 0 else dt.datetime(2023, 12, 20)
        time += dt.timedelta(minutes=rng.randrange(60 if i % 7 == 0 else 60 * 24 * 35), microseconds=rng.randrange(10**6))
        measures = [None if rng.random() < 0.3 else round(rng.uniform(0, 50), 2) for _ in schemas.WEATHER_COLUMNS]
        rows.append((str(i), time, *place, *measures, rng.choice(["Light Fog", "Clear", "Ice", "storm", None])))
    return rows


def frame(spark, rows):
    types = ["string", "timestamp_ntz", "double", "double", *["double"] * 6, "string"]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(COLUMNS, types)))


def expected(rows, places, start, end, clusters):
    """The feature rows worked out one by one."""
    here = {p: [r for r in rows if r[2:4] == p] for p in places}
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    grid = [(p, d, h) for p in places for d in days for h in range(24)]

    def weather(p, d, h):
        found = [r for r in here[p] if (r[1].date(), r[1].hour) == (d, h)]
        values = []
        for i in range(6):
            present = [r[4 + i] for r in found if r[4 + i] is not None]
            values.append(statistics.median(present) if present else None)
        conditions = [r[10] for r in found if r[10] is not None]
        mode = min(sorted(set(conditions)), key=lambda c: -conditions.count(c)) if conditions else None
        return values, mode

    weathers = {g: weather(*g) for g in grid}
    fill = [statistics.median([w[0][i] for w in weathers.values() if w[0][i] is not None]) for i in range(6)]
    frequencies = [len(here[p]) for p, _, _ in grid]
    low, high = np.quantile(frequencies, 0.25), np.quantile(frequencies, 0.75)
    result = {}
    for p, d, h in grid:
        t = dt.datetime.combine(d, dt.time(h))
        back = {n: sum(t - n * HOUR <= r[1] < t for r in here[p]) for n in (24, 72, 168, 720)}
        values, mode = weathers[p, d, h]
        values = [f if v is None else v for v, f in zip(values, fill)]
        n = len(here[p])
        result[p, d, h] = (
            f"{p[0]}_{p[1]}", d.weekday(), d.month, d.weekday() >= 5, d in HOLIDAYS, h in (7, 8, 9, 17, 18, 19),
            *[pytest.approx(v) for v in values], mode, any(w in (mode or "") for w in SEVERE_WORDS),
            n, back[168], back[720], clusters.get(p, -1),
            "highway" if n > high else "arterial" if n >= low else "residential",
            back[24], back[168], pytest.approx(back[72] / 3), pytest.approx(back[168] / 7), pytest.approx(back[720] / 30),
            int(any(t <= r[1] < t + 24 * HOUR for r in here[p])),
        )
    return result


def check(features, want):
    assert features.schema.names == schemas.FEATURES.names
    assert [f.dataType for f in features.schema] == [f.dataType for f in schemas.FEATURES]
    got = {}
    for r in features.collect():
        got[(r.latitude, r.longitude), r.feature_date, r.hour] = (r.location_id, *r[5:])
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == row, key


def cluster_of(spark, rows, size=1.0):
    found = locations.with_degrees(locations.cell_clusters(frame(spark, rows), size)).collect()
    return {(r.latitude, r.longitude): r.cluster_id for r in found}


def test_whole_history(spark):
    rows = events()
    want = expected(
        rows, sorted({r[2:4] for r in rows}), min(r[1] for r in rows).date(), max(r[1] for r in rows).date(),
        cluster_of(spark, rows),
    )
    check(build_features(frame(spark, rows), cluster_method="cells"), want)


def test_listed_places_and_dates(spark):
    rows = events()
    places = [(10.1234, 20.5), (48.85, 2.35), (0.0, 0.5)]
    listed = locations.listed_locations(spark, places)
    got = build_features(
        frame(spark, rows), start="2024-01-03", end="2024-01-07", locations=listed, cluster_method="cells"
    )
    check(got, expected(rows, places, dt.date(2024, 1, 3), dt.date(2024, 1, 7), cluster_of(spark, rows)))


def test_sampled_places(spark):
    rows = events()
    accidents = frame(spark, rows)
    sample = locations.with_degrees(locations.sample_locations(locations.distinct_locations(accidents), 2)).collect()
    places = [(r.latitude, r.longitude) for r in sample]
    got = build_features(
        accidents, start="2024-01-04", end="2024-01-06", max_locations=2, cluster_method="cells"
    )
    check(got, expected(rows, places, dt.date(2024, 1, 4), dt.date(2024, 1, 6), cluster_of(spark, rows)))


def test_kmeans_is_the_default(spark):
    accidents = frame(spark, events())
    features = build_features(accidents, start="2024-01-04", end="2024-01-04")
    per_place = features.select("location_id", "cluster_id").distinct().collect()
    assert len(per_place) == len({r.location_id for r in per_place}) == 5
    assert features.where(F.col("cluster_id") < 0).isEmpty()
