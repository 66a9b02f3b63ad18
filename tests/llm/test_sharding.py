import zlib

import numpy as np

from riskgrid.llm import sharding
from riskgrid.session import scratch_path
from tests.llm.fixture import SCHEMA, corpus, empty, frame


def check(got, rows, shards):
    """All rows are there once, shards have equal counts, slots have no gaps."""
    assert sorted(((r.document.doc_id, r.document.text) for r in got), key=repr) == sorted(rows, key=repr)
    counts = [sum(r.shard == s for r in got) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for s, n in enumerate(counts):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))


def run(spark, df, **options):
    return sharding.shuffle(df, scratch_path(spark, "test-shards"), **options)


def test_whole_rows_with_odd_documents(spark):
    rows = corpus()
    df = frame(spark, rows).withColumn("shard", sharding.F.lit("clash")).withColumn("slot", sharding.F.lit(1))
    shuffled = run(spark, df, bucket_bytes=20_000)
    got = shuffled.collect()
    check(got, rows, 40)
    assert {r.document.shard for r in got} == {"clash"}
    digests = [tuple(r) for r in sharding.digests(shuffled).collect()]
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows]
    assert sorted((d[:3] for d in digests), key=repr) == sorted(want, key=repr)
    assert {(d[3], d[6]) for d in digests} == {("rows", None)}


def test_same_order_for_any_partitioning(spark):
    rows = [(i, f"text {i}") for i in range(500)]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    orders = []
    for parts, seed in ((1, 1), (7, 1), (7, 2)):
        got = run(spark, df.repartition(parts, "text"), shards=3, seed=seed, bucket_bytes=4000).collect()
        check(got, rows, 3)
        orders.append([r.document.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))])
    assert orders[0] == orders[1] != orders[2]
    assert orders[0] != sorted(orders[0])


def test_order_is_random(spark):
    """Places of neighbouring rows are spread evenly and have nothing to do with each other."""
    rows = [(i, "t") for i in range(4000)]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    got = run(spark, df, shards=1, bucket_bytes=5000).collect()
    place = np.empty(4000)
    place[[r.document.doc_id for r in got]] = [r.slot for r in got]
    assert abs(np.corrcoef(np.arange(4000), place)[0, 1]) < 0.06
    assert abs(np.corrcoef(place[1:], place[:-1])[0, 1]) < 0.06
    assert abs(np.mean(place[:1000]) - 2000) < 150


def test_a_row_repeated_many_times_is_scattered(spark):
    rows = [(1, "same")] * 3000 + [(i, f"other {i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(4)
    got = run(spark, df, bucket_bytes=10_000).collect()
    check(got, rows, 40)
    hot = np.bincount([r.shard for r in got if r.document.doc_id == 1], minlength=40)
    assert hot.min() > 40 and hot.max() < 120


def test_keys_do_not_depend_on_order():
    digests = np.array([5, 7, 5, 5, 9, 7], np.int64)
    keys = sharding.scatter_keys(digests, {}, 3, 2)
    turned = sharding.scatter_keys(digests[::-1].copy(), {}, 3, 2)
    assert sorted(keys) == sorted(turned) and len(set(keys)) == 6
    assert sorted(sharding.fisher_yates(100, 1, 2)) == list(range(100))


def test_empty_table_and_few_rows(spark):
    assert run(spark, empty(spark)).collect() == []
    check(run(spark, frame(spark, [(1, None)])).collect(), [(1, None)], 40)


def test_long_text(spark):
    rows = [(1, "x" * 3_000_000), (2, "y")]
    check(run(spark, frame(spark, rows), bucket_bytes=100_000).collect(), rows, 40)
