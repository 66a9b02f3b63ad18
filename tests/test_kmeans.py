import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgrid.operators import kmeans, locations
from riskgrid.queries import views

SMALL = "/root/testdata/sf0.001"


def positions(spark, n=3000, seed=1):
    rng = random.Random(seed)
    centres = [(rng.uniform(25, 49), rng.uniform(-120, -70)) for _ in range(12)]
    rows = [(a + rng.gauss(0, 0.4), b + rng.gauss(0, 0.4), rng.randrange(1, 5)) for a, b in (rng.choice(centres) for _ in range(n))]
    return spark.createDataFrame(rows, "latitude double, longitude double, events long").repartition(4)


def cost_of(frame, centres):
    rows = frame.collect()
    at = np.array([(r.latitude, r.longitude) for r in rows])
    return float((kmeans.nearest(at, centres)[1] * [r.events for r in rows]).sum())


def test_cost_is_that_of_the_best_restart(spark):
    frame = positions(spark).cache()
    found = kmeans.fit(frame, 12, 42, 5)
    assert len(found.costs) == 5 and found.cost == min(found.costs)
    assert cost_of(frame, found.centres) == pytest.approx(found.cost)
    # Every single seed is one of the restarts, and none is better.
    for k in range(5):
        assert kmeans.fit(frame, 12, 42 + k, 1).cost == pytest.approx(found.costs[k])


def test_as_good_as_mllib(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    frame = positions(spark, seed=3).cache()
    vectors = VectorAssembler(inputCols=["latitude", "longitude"], outputCol="features").transform(frame)
    theirs = min(KMeans(k=12, seed=s, weightCol="events", maxIter=300).fit(vectors).summary.trainingCost for s in range(5))
    assert kmeans.fit(frame, 12, 42, 10).cost <= theirs * 1.02


def test_centres_are_means_of_their_positions(spark):
    frame = positions(spark, seed=5)
    found = kmeans.fit(frame, 12, 1, 2)
    rows = kmeans.assign(frame, found.centres).collect()
    for k, centre in enumerate(found.centres):
        mine = [r for r in rows if r.cluster_id == k]
        weight = sum(r.events for r in mine)
        mean = [sum(r.events * r[c] for r in mine) / weight for c in ("latitude", "longitude")]
        assert mean == pytest.approx(list(centre), abs=1e-3)


def test_passes_do_not_grow_with_restarts(spark):
    """A position's table is read once per pass; ten restarts take as many passes as the slowest of them."""
    frame = positions(spark, seed=7).cache()
    alone = [kmeans.fit(frame, 12, 42 + k, 1).passes for k in range(4)]
    assert kmeans.fit(frame, 12, 42, 4).passes == max(alone)


def test_few_or_no_positions(spark):
    few = spark.createDataFrame([(1.0, 2.0, 5), (3.0, 4.0, 1)], "latitude double, longitude double, events long")
    found = kmeans.fit(few, 50, 1, 3)
    assert len(found.centres) == 2 and found.cost == 0.0
    none = kmeans.fit(few.where("false"), 50, 1, 3)
    assert len(none.centres) == 0


def test_raw_events_are_read_once(spark):
    accidents = views.accidents(spark, SMALL)
    result, found, assigned = locations.kmeans_with_costs(accidents, clusters=5, restarts=3)
    for frame in (result, assigned):
        files = frame.inputFiles()
        assert files and all("positions" in f for f in files)
    assert cost_of(assigned.select("latitude", "longitude", "events"), found.centres) == pytest.approx(found.cost)


def test_blocks_leave_out_no_nearest_centre():
    rng = np.random.default_rng(1)
    centres = np.concatenate([rng.uniform(-3, 3, (40, 2)), [[1.0, 1.0], [1.0, 1.0], [1.0, 2.0]]])
    grid = np.stack(np.meshgrid(np.arange(0, 3, 0.25), np.arange(0, 3, 0.25)), axis=-1).reshape(-1, 2)
    points = np.concatenate([rng.uniform(-3, 3, (60_000, 2)), grid])
    points = points[kmeans._in_blocks(points)]
    of, cost = kmeans.nearest(points, centres)
    apart = (points[:, :1] - centres[:, 0]) ** 2 + (points[:, 1:] - centres[:, 1]) ** 2
    assert (of == apart.argmin(axis=1)).all() and (cost == apart.min(axis=1)).all()
    near = [len(kmeans._within_reach(points[i : i + kmeans.BLOCK], centres)) for i in range(0, len(points), kmeans.BLOCK)]
    assert np.mean(near) < len(centres) / 2


def test_positions_of_one_file_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "positions")
    positions(spark, 3000).coalesce(1).write.parquet(path)
    frame = spark.read.parquet(path)
    monkeypatch.setattr(kmeans, "TASK_CELLS", 1 << 14)
    dealt = kmeans._dealt(frame, 50)
    held = dealt.groupBy(F.input_file_name()).count().collect()
    assert len(held) >= 8 and max(r["count"] for r in held) <= 1000
    order = ["latitude", "longitude", "events"]
    assert [tuple(r) for r in dealt.orderBy(*order).collect()] == [tuple(r) for r in frame.orderBy(*order).collect()]
