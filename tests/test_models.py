import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskgrid.operators import encoding, locations, scoring, training
from riskgrid.plans import endtoend
from riskgrid.plans.score import predictions_of, score_day
from riskgrid.plans.train import best_by_test_auc, train_models
from riskgrid.queries import registry, views
from riskgrid.schemas import TARGET
from riskgrid.sources import models, scans

SMALL = "/root/testdata/sf0.001"
# Queries whose models are fitted on the whole train split.
WHOLE = ["q65_logistic_regression", "q66_random_forest", "q68_boosted_trees_balanced"]


@pytest.fixture(scope="module")
def features(spark):
    return registry.feature_table(spark, SMALL)


@pytest.fixture(scope="module")
def trained(spark, features):
    from riskgrid.session import scratch_path

    root = scratch_path(spark, "models-test")
    found, report = train_models(features, "v1", "2024-02-01", registry.QUICK, f"{root}/models", f"{root}/metadata")
    return root, found, report.collect(), report


def test_every_model_beats_chance(trained):
    _, found, report, frame = trained
    assert set(found) == {s.name for s in registry.QUICK} == {s.name for s in training.DEFAULT_MODELS}
    by_key = {(r.model_name, r.split): r for r in report}
    assert len(by_key) == 12
    for name in found:
        test = by_key[name, "test"]
        assert test.auc > 0.6
        outcomes = ("true_positives", "false_positives", "true_negatives", "false_negatives")
        sizes = {split: sum(by_key[name, split][c] for c in outcomes) for split in ("train", "val", "test")}
        assert sizes["train"] > sizes["val"] > 0 and abs(sizes["test"] - sizes["val"]) <= 2
    assert best_by_test_auc(frame).first().auc == max(r.auc for r in report if r.split == "test")


def test_metadata_rows(spark, trained):
    root, found, report, _ = trained
    stored = scans.parquet_table(spark, f"{root}/metadata").collect()
    assert {r.model_name for r in stored} == set(found)
    for r in stored:
        assert r.features_used == found[r.model_name].features
        assert r.train_samples > r.val_samples > 0 and r.test_samples > 0
        assert 0 < r.auc_score <= 1


def test_saved_model_scores_the_same(spark, features, trained):
    root, found, _, _ = trained
    for name, original in found.items():
        loaded = models.load_model(spark, f"{root}/models/{name}/v1")
        assert (loaded.features, loaded.categories) == (original.features, original.categories)
        a = predictions_of(features, original).agg(F.sum("risk_score"), F.min("risk_score"), F.max("risk_score")).first()
        b = predictions_of(features, loaded).agg(F.sum("risk_score")).first()
        assert a[0] == pytest.approx(b[0]) and 0 <= a[1] <= a[2] <= 1


def test_prediction_keeps_the_key(features, trained):
    _, found, _, _ = trained
    rows = predictions_of(features, found["random_forest"], include_features=True)
    assert rows.count() == features.count()
    keys = rows.select("prediction_date", "location_id", "prediction_hour").distinct().count()
    assert keys == features.count()
    assert rows.schema["prediction_hour"].dataType.simpleString() == "int"
    assert rows.where("features is null").isEmpty()


def test_score_day_writes_once_and_skips_empty_days(spark, features, trained, scratch):
    _, found, _, _ = trained
    model = found["random_forest"]
    empty = score_day(features, model, "2030-01-01", f"{scratch}/t", f"{scratch}/f")
    assert empty.isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scans.parquet_table(spark, f"{scratch}/t")
    for _ in range(2):
        zones = score_day(features, model, "2024-01-10", f"{scratch}/t", f"{scratch}/f")
    stored = scans.parquet_table(spark, f"{scratch}/t")
    assert stored.count() == features.where("feature_date = '2024-01-10'").count()
    assert zones.count() == min(10, stored.where("risk_category = 'High'").count())


def test_feature_importance(spark, trained):
    root, found, _, _ = trained
    for name, model in found.items():
        if name == "logistic_regression":
            continue
        rows = training.feature_importance(model.model, model.features).collect()
        assert sorted(r.feature for r in rows) == sorted(model.features)
        values = [r.importance for r in rows]
        assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1.0)
        stored = spark.read.option("header", True).csv(f"{root}/models/{name}/v1/feature_importance").collect()
        assert [r.feature for r in stored] == [r.feature for r in rows]


def test_encoding(spark):
    frame = spark.createDataFrame([("b", None), ("a", 1.0), ("c", 2.0), ("z", 3.0)], "road_type string, x double")
    encoded = encoding.one_hot(frame, ["a", "b", "c"])
    assert [tuple(r) for r in encoded.collect()] == [(None, 1, 0), (1.0, 0, 0), (2.0, 0, 1), (3.0, 0, 0)]
    vectors = encoding.assemble(encoded, ["road_type_c", "x", "road_type_b"]).collect()
    assert [list(r.features.toArray()) for r in vectors] == [[0, 0, 1], [0, 1, 0], [1, 2, 0], [0, 3, 0]]
    with pytest.raises(ValueError):
        encoding.assemble(frame, ["road_type"])
    aligned = scoring.prepare_features(frame, ["x", "missing", "road_type_b"], ["a", "b", "c"], ["x"])
    assert aligned.columns == ["x", "x", "missing", "road_type_b"]


def test_vocabulary_is_sorted_and_bounded(spark):
    frame = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "road_type string")
    assert encoding.vocabulary(frame) == ["a", "b"]
    many = spark.range(1500).select(F.col("id").cast("string").alias("road_type"))
    assert len(encoding.vocabulary(many)) == 1500
    with pytest.raises(ValueError):
        encoding.vocabulary(many, most=1000)


def test_kmeans_assigns_every_place(spark):
    accidents = views.accidents(spark, SMALL)
    got = locations.kmeans_clusters(accidents, clusters=5, restarts=2).collect()
    assert len(got) == locations.distinct_locations(accidents).count()
    assert {r.cluster_id for r in got} <= set(range(5)) and len({r.cluster_id for r in got}) > 1


def test_end_to_end_steps(spark, scratch):
    views.raw(spark, SMALL).write.option("header", True).csv(f"{scratch}/raw")
    project = endtoend.Project(
        scratch, f"{scratch}/raw", "2024-01-15", "v1", "2024-02-01", calendar_end="2024-12-31",
        model_name="logistic_regression", specs=registry.QUICK[:1], feature_options={"cluster_method": "cells"},
    )
    zones = endtoend.run(spark, project)
    assert zones.count() <= 10
    stored = scans.parquet_table(spark, project.path("predictions"))
    events = scans.parquet_table(spark, project.path("accidents"))
    assert stored.count() == 24 * locations.distinct_locations(events).count()
    before = events.count()
    endtoend.run(spark, project, "ingestion")
    assert scans.parquet_table(spark, project.path("accidents")).count() == before
    again = endtoend.run(spark, project, skip_ingestion=True, skip_training=True)
    assert again.count() == zones.count()
    with pytest.raises(ValueError):
        endtoend.run(spark, project, "deploy")


def test_newest_or_named_version_is_scored(spark, features, scratch):
    root, table = f"{scratch}/models", f"{scratch}/metadata"
    trained = {}
    for version, when, rate in (("v1", "2024-02-01", 0.1), ("v3", "2024-02-03", 0.5), ("v2", "2024-02-02", 0.3)):
        spec = training.ModelSpec("lightgbm", "grown_boosted", {"trees": 2, "max_depth": 3, "rate": rate})
        trained[version], _ = train_models(features, version, when, [spec], root, table, 500, 1000)
    metadata = scans.parquet_table(spark, table)
    sums = {}
    for asked, version in ((None, "v3"), ("v1", "v1"), ("v2", "v2")):
        loaded = models.load_recorded(spark, metadata, "lightgbm", asked)
        assert loaded.version == version
        rows = predictions_of(features, loaded).agg(F.sum("risk_score"), F.min("model_version"), F.max("model_version")).first()
        want = predictions_of(features, trained[version]["lightgbm"]).agg(F.sum("risk_score")).first()
        assert rows[0] == pytest.approx(want[0]) and rows[1] == rows[2] == version
        sums[version] = rows[0]
    assert len(set(sums.values())) == 3
    for name, version in (("lightgbm", "v9"), ("xgboost", None)):
        with pytest.raises(ValueError, match="no stored model"):
            models.load_recorded(spark, metadata, name, version)


def test_ingestion_counts_what_it_removed(spark, scratch):
    """The counts of another pass, seen while the table was written; later runs of a policy that writes nothing see none."""
    from riskgrid.operators.cleaning import cleaning_summary

    raw = views.raw(spark, SMALL)
    bad = raw.limit(7).withColumn("Start_Lat", F.lit("95"))
    raw.unionByName(bad).write.option("header", True).csv(f"{scratch}/raw")
    project = endtoend.Project(scratch, f"{scratch}/raw", "2024-01-15", "v1", "2024-02-01", write_policy="cancel")
    counts = endtoend.ingest(spark, project)
    summary = cleaning_summary(scans.csv_events(spark, f"{scratch}/raw")).first()
    assert (counts["rows_in"], counts["rows_kept"]) == (summary.rows_in, summary.rows_kept)
    assert counts["rows_removed"] == summary.rows_in - summary.rows_kept >= 7
    assert set(endtoend.ingest(spark, project).values()) == {0}


def test_calendar_covers_all_events_by_default(spark, scratch):
    views.raw(spark, SMALL).write.option("header", True).csv(f"{scratch}/raw")
    project = endtoend.Project(
        scratch, f"{scratch}/raw", "2024-01-15", "v1", "2024-02-01", feature_options={"cluster_method": "cells"}
    )
    endtoend.run(spark, project, "ingestion")
    endtoend.run(spark, project, "features")
    features = scans.parquet_table(spark, project.path("features_daily"))
    assert features.where("day_of_week is null or month is null or is_holiday is null").isEmpty()
    assert not features.where("feature_date > '2024-01-15'").isEmpty()
    calendar = scans.parquet_table(spark, project.path("calendar")).where("date < '2024-01-20'").collect()
    spark.createDataFrame(calendar).write.mode("overwrite").parquet(project.path("calendar"))
    with pytest.raises(ValueError, match="calendar"):
        endtoend.run(spark, project, "features")


def test_scratch_is_cleared(spark, scratch, monkeypatch):
    from riskgrid import session

    # A folder of its own: other tests still read what this application has staged.
    monkeypatch.setattr(session, "_own_scratch", lambda _: scratch)
    staged = session.stage(spark.range(3).toDF("id"), "to-clear")
    assert staged.count() == 3 and session.clear_scratch(spark)
    assert not session.clear_scratch(spark)


def test_bounds_apply_to_the_train_split_alone(features):
    from riskgrid.plans.train import training_set

    n = {r[TARGET]: r["count"] for r in features.where(F.col(TARGET).isin(0, 1)).groupBy(TARGET).count().collect()}
    data = training_set(features, 100, 300)
    assert data.rows["train"] == 400
    assert data.rows["val"] == sum(int(x * 0.85) - int(x * 0.7) for x in n.values())
    assert data.rows["test"] == sum(x - int(x * 0.85) for x in n.values())
    whole = training_set(features, 10**9, 10**9)
    assert whole.rows == {**data.rows, "train": sum(int(x * 0.7) for x in n.values())}
    of_class = {r[TARGET]: r["count"] for r in data.vectors.where("split = 'train'").groupBy(TARGET).count().collect()}
    assert of_class == {1: 100, 0: 300}


def test_compared_models_are_the_default_ones(spark, features, monkeypatch):
    asked = []

    def train(features, version, trained_at, specs, **bounds):
        asked.extend(specs)
        return train_models(features, version, trained_at, registry.QUICK[:1], **bounds)

    monkeypatch.setattr(registry, "train_models", train)
    registry.q71_train_and_compare(spark, SMALL).collect()
    # All settings but the number of boosted trees.
    free = lambda spec: (spec.name, spec.family, spec.positive_weight, {**spec.params, "trees": 0})
    assert list(map(free, asked)) == list(map(free, training.DEFAULT_MODELS))
    assert asked[:2] == training.DEFAULT_MODELS[:2]


def test_evaluation_scores_a_row_once(spark):
    """The score is used in several conditions and a filter of the metrics; the model is asked once per row for all."""
    rows = spark.range(200).selectExpr("'test' as split", f"cast(id % 3 = 0 as int) as {TARGET}", "cast(id as double) as a")
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows).withColumn("weight", F.lit(1.0))
    fitted = RandomForestClassifier(labelCol=TARGET, numTrees=2, maxDepth=2, seed=1).fit(vectors)
    plan = training.evaluate(fitted, vectors)._jdf.queryExecution().optimizedPlan().toString()
    once = training.with_probability(fitted, vectors).select("p")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") == once.count("UDF(") > 0


def test_unbounded_models_are_fitted_on_the_whole_train_split(spark, features, monkeypatch):
    """The bounds of the other queries don't reach them, and all rows of the train split go to the fit."""
    seen = []

    def fit(train, spec, rows):
        seen.append((train.count(), rows))
        return real(train, registry.QUICK[0], rows=rows)

    real = training.fit
    monkeypatch.setattr(registry, "POSITIVES", 50)
    monkeypatch.setattr(registry, "NEGATIVES", 70)
    monkeypatch.setattr(training, "fit", fit)
    n = [r["count"] for r in features.where(F.col(TARGET).isin(0, 1)).groupBy(TARGET).count().collect()]
    whole = sum(int(x * 0.7) for x in n)
    for name in WHOLE:
        report = {r.split: r.rows for r in registry.QUERIES[name](spark, SMALL).collect()}
        assert seen.pop() == (whole, whole) and sum(report.values()) == sum(n) and report["train"] == whole
