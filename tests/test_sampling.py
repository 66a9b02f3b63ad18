import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskgrid.operators import ranking, sampling
from riskgrid.operators.locations import cell_clusters


def labelled(spark, positives, negatives):
    ids = spark.range(positives + negatives).withColumn("y", (F.col("id") < positives).cast("int"))
    return ids.repartition(4)


def in_hash_order(ids):
    return sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


@pytest.mark.parametrize("positives, negatives", [(1, 1), (7, 100), (1003, 3001), (20_000, 10)])
def test_split_is_exact_per_class(spark, positives, negatives):
    frame = labelled(spark, positives, negatives)
    got = sampling.stratified_split(frame, "y", ["id"]).collect()
    assert len({r.id for r in got}) == len(got) == positives + negatives
    split = {r.id: r.split for r in got}
    for ids in (range(positives), range(positives, positives + negatives)):
        n = len(ids)
        ordered = in_hash_order(ids)
        first, second = math.floor(n * 0.70), math.floor(n * 0.85)
        want = ["train"] * first + ["val"] * (second - first) + ["test"] * (n - second)
        assert [split[i] for i in ordered] == want


def test_unknown_labels_have_no_weight(spark):
    frame = spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int")
    got = sampling.with_balanced_weight(frame, "y").collect()
    assert [r.weight for r in got] == [0.75, 0.75, 1.5, None]


@pytest.mark.parametrize("cap", [0, 1, 17, 5000, 10_000_000])
def test_class_sample_is_the_first_in_hash_order(spark, cap):
    frame = labelled(spark, 5000, 50)
    got = {r.id for r in sampling.class_sample(frame, "y", 1, cap, ["id"]).collect()}
    assert got == set(in_hash_order(range(5000))[:cap])


def test_ranks_hold_when_all_rows_share_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_BUCKET_DIGITS", 0)
    test_split_is_exact_per_class(spark, 503, 77)


def test_undersample(spark):
    got = Counter(r.y for r in sampling.undersample(labelled(spark, 900, 41), "y", ["id"]).collect())
    assert got == {1: 41, 0: 41}


def test_sample_union_and_order(spark):
    frame = labelled(spark, 300, 500)
    sample = sampling.training_sample(frame, "y", 100, 200, ["id"])
    assert Counter(r.y for r in sample.collect()) == {1: 100, 0: 200}
    assert [r.id for r in sampling.shuffled(frame, ["id"]).collect()] == in_hash_order(range(800))


def test_balanced_weights(spark):
    rows = sampling.with_balanced_weight(labelled(spark, 30, 70), "y").collect()
    assert {(r.y, round(r.weight, 9)) for r in rows} == {(1, round(100 / 60, 9)), (0, round(100 / 140, 9))}
    assert sum(r.weight for r in rows) == pytest.approx(100)


def test_time_split(spark):
    days = spark.sql("select explode(sequence(date '2016-02-01', date '2016-03-05')) as feature_date")
    got = sampling.time_split(days, "2016-02-15", "2016-02-20", "2016-02-28").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 15, "val": 5, "test": 8}


def test_cells_are_numbered_by_first_appearance(spark):
    rows = [
        ("a", "2024-01-03 00:00:00", 5.5, 5.5),
        ("b", "2024-01-01 00:00:00", 9.5, 0.5),
        ("c", "2024-01-01 00:30:00", 1.5, 1.5),
        ("d", "2024-01-01 00:30:00", 0.5, 1.5),
        ("e", "2024-01-04 00:00:00", 9.6, 0.5),
    ]
    frame = spark.createDataFrame(rows, "accident_id string, t string, latitude double, longitude double")
    frame = frame.withColumn("timestamp", F.col("t").cast("timestamp_ntz"))
    got = {(r.lat_e4, r.lon_e4): r.cluster_id for r in cell_clusters(frame, 1.0).collect()}
    assert got == {(95000, 5000): 0, (96000, 5000): 0, (5000, 15000): 1, (15000, 15000): 2, (55000, 55000): 3}


def test_more_groups_than_the_broadcast_allows_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MOST_GROUPS", 1)
    with pytest.raises(Exception, match="too many groups"):
        sampling.undersample(labelled(spark, 5, 5), "y", ["id"]).collect()


def test_unknown_labels_are_a_group_of_their_own(spark):
    frame = spark.range(30).withColumn("y", F.when(F.col("id") < 10, 1).when(F.col("id") < 16, 0))
    got = Counter(r.y for r in sampling.undersample(frame, "y", ["id"]).collect())
    assert got == {1: 6, 0: 6, None: 6}


def test_cuts_read_whole_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    labelled(spark, 50, 70).withColumn("payload", F.col("id") * 2).write.parquet(path)
    plan = sampling.stratified_split(spark.read.parquet(path), "y", ["id"])._jdf.queryExecution().sparkPlan().toString()
    assert sum("payload" in line for line in plan.splitlines() if "ReadSchema" in line) == 1


@pytest.mark.parametrize("deviations", [0.0, 0.2])
def test_cuts_outside_their_brackets_are_exact(spark, monkeypatch, deviations):
    monkeypatch.setattr(ranking, "_DEVIATIONS", deviations)
    test_split_is_exact_per_class(spark, 1003, 3001)
    test_class_sample_is_the_first_in_hash_order(spark, 17)


def test_the_digest_is_worked_out_once_per_row(spark):
    """One pass finds the cuts and one reads whole rows; neither hashes a row again for each cut or condition."""
    cut = sampling.bounded_split(labelled(spark, 300, 500), "y", 100, 200, ["id"]).where("split <> 'test'")
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    placing = plan.split("Generate")[0]
    assert "md5" not in placing
    for line in plan.splitlines():
        assert line.count("md5(") <= 1
