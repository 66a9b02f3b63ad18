import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.operators import scoring, serving
from riskgrid.sources import scans, sinks


def frame(spark, *rows):
    return spark.createDataFrame(rows, "accident_id string, t string, v int").select(
        "accident_id", F.col("t").cast("timestamp_ntz").alias("timestamp"), "v"
    )


def content(spark, path):
    return sorted((r.accident_id, r.v) for r in scans.parquet_table(spark, path).collect())


def test_insert_ignore(spark, scratch):
    first = frame(spark, ("a", "2024-01-02", 1), ("a", "2024-01-01", 2), ("b", "2024-01-01", 3))
    sinks.insert_ignore(first, scratch)
    assert content(spark, scratch) == [("a", 2), ("b", 3)]
    second = frame(spark, ("a", "2023-01-01", 9), ("c", "2024-01-05", 4), ("c", "2024-01-04", 5))
    for _ in range(2):
        sinks.insert_ignore(second, scratch)
    assert content(spark, scratch) == [("a", 2), ("b", 3), ("c", 5)]


def test_insert_ignore_full_event_row(spark, scratch):
    row = spark.range(3).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ACCIDENTS if f.name not in schemas.REQUIRED_COLUMNS],
        F.lit("a").alias("accident_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"),
        F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
    )
    sinks.insert_ignore(sinks.with_point(row.drop("location")), scratch)
    stored = scans.parquet_table(spark, scratch, schemas.ACCIDENTS).collect()
    assert len(stored) == 1 and tuple(stored[0].location) == (2.0, 1.0, 4326)


def test_write_policies(spark, scratch):
    old, new = frame(spark, ("a", "2024-01-01", 1)), frame(spark, ("b", "2024-01-01", 2))
    sinks.write_table(old, scratch, "fail")
    sinks.write_table(new, scratch, "cancel")
    assert content(spark, scratch) == [("a", 1)]
    sinks.write_table(new, scratch, "append")
    assert content(spark, scratch) == [("a", 1), ("b", 2)]
    sinks.write_table(new, scratch, "replace")
    assert content(spark, scratch) == [("b", 2)]
    with pytest.raises(FileExistsError):
        sinks.write_table(new, scratch, "fail")
    for policy in ("cancel", "fail"):
        sinks.truncate(spark, scratch)
        sinks.write_table(old, scratch, policy)
        assert content(spark, scratch) == [("a", 1)]
    with pytest.raises(ValueError):
        sinks.write_table(new, scratch, "ask")


def test_truncate_keeps_the_schema(spark, scratch):
    old = frame(spark, ("a", "2024-01-01", 1))
    sinks.write_table(old, scratch)
    sinks.truncate(spark, scratch)
    stored = scans.parquet_table(spark, scratch)
    assert stored.isEmpty() and stored.columns == old.columns
    sinks.truncate_and_load(old, scratch)
    sinks.truncate_and_load(old, scratch)
    assert content(spark, scratch) == [("a", 1)]


def predictions(spark, *rows):
    return spark.createDataFrame(
        rows, "d string, prediction_hour int, location_id string, risk_score double, model_version string"
    ).select(
        F.col("d").cast("date").alias("prediction_date"), "prediction_hour", "location_id",
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), "risk_score",
        F.when(F.col("risk_score") >= 0.75, "High").when(F.col("risk_score") >= 0.5, "Medium").otherwise("Low")
        .alias("risk_category"),
        "model_version", F.lit(None).cast("string").alias("features"),
    )


def test_replace_days(spark, scratch):
    both = predictions(spark, ("2024-01-01", 0, "x", 0.9, "v1"), ("2024-01-02", 0, "x", 0.8, "v1"))
    sinks.replace_days(both, scratch)
    again = predictions(spark, ("2024-01-02", 5, "y", 0.1, "v2"))
    for _ in range(2):
        sinks.replace_days(again, scratch)
    sinks.replace_days(both.where("false"), scratch)
    got = scans.parquet_table(spark, scratch).orderBy("prediction_date").collect()
    assert [(r.prediction_hour, r.location_id) for r in got] == [(0, "x"), (5, "y")]


def rows_scanned(df):
    """Rows that the file scan gave out, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_place_is_found_without_reading_other_row_groups(spark, scratch):
    day = predictions(spark, ("2024-01-01", 0, "x", 0.9, "v1"))
    places = F.explode(F.sequence(F.lit(0), F.lit(1998), F.lit(2)))
    many = day.withColumn("k", places).withColumn("location_id", F.format_string("place%04d", "k")).drop("k")
    sinks.replace_days(many, scratch)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = scans.parquet_table(spark, scratch)
        # Between the smallest and the largest place, so minimum and maximum don't tell: the Bloom filter does.
        absent, there = (stored.where(F.col("location_id") == p).select("prediction_hour") for p in ("place0501", "place0500"))
        assert rows_scanned(there) == 1000 and rows_scanned(absent) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_prediction_files(spark, scratch, kind):
    sinks.write_prediction_files(predictions(spark, ("2024-01-01", 0, "x", 0.9, "v1")), scratch, kind)
    read = spark.read.option("header", True).format(kind).load(scratch)
    assert ("features" in read.columns) == (kind == "parquet")
    assert read.count() == 1


def test_features_are_pruned_by_day(spark, scratch):
    days = "explode(sequence(date '2024-01-01', date '2024-01-03')) as feature_date"
    rows = spark.sql(f"select {days}, 3 as hour, 'p' as location_id")
    sinks.write_features(rows, scratch)
    day = scoring.features_for_day(scans.parquet_table(spark, scratch), "2024-01-02")
    assert day.count() == 1
    assert "PartitionFilters: [isnotnull(feature_date" in day._jdf.queryExecution().executedPlan().toString()
    assert scoring.features_for_day(scans.parquet_table(spark, scratch), "2024-01-02", []).isEmpty()
    assert scoring.features_for_day(scans.parquet_table(spark, scratch), "2025-01-02").isEmpty()


def test_key_violations_and_facts(spark):
    df = frame(spark, ("a", "2024-01-01", 1), ("a", "2024-01-03", 2), ("b", "2024-01-02", 1))
    assert [tuple(r) for r in scans.key_violations(df, ["accident_id"]).collect()] == [("a", 2)]
    assert tuple(scans.table_facts(df).first()) == (3, "2024-01-03")
    assert tuple(scans.table_facts(df.where("false")).first()) == (0, None)
    assert not scans.table_exists(spark, "no_such_table")


def test_read_sql_parameters(spark):
    df = frame(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 5))
    text = "select accident_id from {t} where v > :v"
    assert [r[0] for r in scans.read_sql(spark, text, {"v": 2}, t=df).collect()] == ["b"]
    assert scans.read_sql(spark, "select count(*) from {t}", t=df).first()[0] == 2
    text = "select accident_id from {t} where accident_id = ?"
    assert scans.read_sql(spark, text, ["x' or '1'='1"], t=df).isEmpty()


def test_metadata_round_trip(spark, scratch):
    row = sinks.metadata_row(
        spark, "m", "v1", "2024-01-01 10:00:00", {"auc": 0.5}, ["a", "b"], {"train": 7}, {"depth": 3}, "/p"
    )
    sinks.append_metadata(row, scratch)
    sinks.append_metadata(row, scratch)
    assert scans.key_violations(scans.parquet_table(spark, scratch), schemas.TABLE_KEYS["model_metadata"]).isEmpty()
    newer = sinks.metadata_row(spark, "m", "v2", "2024-01-02 10:00:00", {}, ["a"])
    sinks.append_metadata(newer, scratch)
    stored = scans.parquet_table(spark, scratch)
    assert stored.schema.names == schemas.MODEL_METADATA.names
    latest = scoring.latest_metadata(stored, "m").first()
    assert (latest.model_version, latest.auc_score, latest.features_used) == ("v2", 0.0, ["a"])
    assert scoring.latest_metadata(stored).first().training_date == dt.datetime(2024, 1, 2, 10)


def test_serving_arguments(spark):
    p = predictions(spark, ("2024-01-01", 0, "x", 0.9, "v1"))
    for call in (
        lambda: serving.predictions_by_date(p, "01/01/2024"),
        lambda: serving.predictions_by_date(p, "2024-01-01", 0),
        lambda: serving.predictions_by_date(p, "2024-01-01", 10_001),
        lambda: serving.predictions_by_location(p, "x", "yesterday"),
        lambda: serving.high_risk_zones(p, "2024-01-01", 101),
        lambda: serving.high_risk_zones(p, "2024-01-01", 10, 1.5),
    ):
        with pytest.raises(ValueError):
            call()
    assert serving.predictions_by_location(p, "nowhere").isEmpty()


def test_serving_results(spark):
    p = predictions(
        spark,
        ("2024-01-01", 0, "x", 0.9, "v1"), ("2024-01-01", 1, "x", 0.75, "v1"), ("2024-01-01", 2, "y", 0.6, "v2"),
        ("2024-01-02", 0, "x", 0.1, "v2"), ("2024-01-02", 1, "y", 0.2, "v1"),
    )
    report = serving.high_risk_report(p, "2024-01-01").first()
    assert report.total_zones == 2 and [z.prediction_hour for z in report.zones] == [0, 1]
    empty = serving.high_risk_report(p, "2025-01-01").first()
    assert (empty.total_zones, empty.zones) == (0, [])
    assert tuple(serving.statistics(p).first()) == (5, 2, 1, 2, "2024-01-02", "v1")
    assert tuple(serving.statistics(p.where("false")).first()) == (0, 0, 0, 0, None, None)
    hours = [(r.prediction_date, r.prediction_hour) for r in serving.predictions_by_location(p, "x").collect()]
    assert hours == [("2024-01-02", 0), ("2024-01-01", 0), ("2024-01-01", 1)]


def test_feature_writers_sort_few_rows_each(spark, scratch, monkeypatch):
    monkeypatch.setattr(sinks, "FEATURE_BYTES", "64k")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    rows = spark.range(200_000).repartition(40).selectExpr(
        "date '2024-01-01' as feature_date", "md5(cast(id as string)) as location_id", "cast(id % 24 as int) as hour"
    )
    sinks.write_features(rows, scratch)
    stored = spark.read.parquet(scratch)
    assert stored.count() == stored.distinct().count() == 200_000
    assert len(stored.inputFiles()) > 20 and spark.conf.get(advisory) == before


def test_a_copied_date_is_written_by_many_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(sinks, "FEATURE_ROWS", 5_000)
    rows = spark.range(100_000).coalesce(1).selectExpr(
        "date '2024-01-01' as feature_date", "md5(cast(id as string)) as location_id", "cast(id % 24 as int) as hour"
    )
    sinks.write_features(rows, scratch, rows=100_000)
    stored = spark.read.parquet(scratch)
    held = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert stored.distinct().count() == sum(held) == 100_000 and len(held) >= 15 and max(held) <= 10_000
