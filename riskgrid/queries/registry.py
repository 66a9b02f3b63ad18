"""One query per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.functions.geo import KEY, with_location_key
from riskgrid.functions.risk import as_json, risk_category
from riskgrid.operators import calendar as cal
from riskgrid.operators import cleaning, encoding, grid, locations, metrics, sampling, scoring, serving, training
from riskgrid.operators import weather as wx
from riskgrid.operators import windows as win
from riskgrid.operators.quantiles import exact_medians, exact_modes
from riskgrid.plans import endtoend
from riskgrid.plans.features import build_features, grid_medians, place_hours
from riskgrid.plans.score import predictions_of, score_day
from riskgrid.plans.train import best_by_test_auc, train_models, training_set
from riskgrid.queries import views
from riskgrid.session import scratch_path, stage
from riskgrid.sources import models, scans, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TARGET = schemas.TARGET
ROW_KEY = ["feature_date", "location_id", "hour"]
DAY = "2024-01-15"
RUN_TIME = "2024-02-01 00:00:00"
# Labelled rows of each class that model queries fit on at most, if they don't fit on the whole train split.
POSITIVES, NEGATIVES = 2_000, 8_000


def _with_trees(*trees: int) -> list[training.ModelSpec]:
    """The default models with so many trees."""
    linear, *others = training.DEFAULT_MODELS
    return [linear, *[replace(s, params={**s.params, "trees": n}) for s, n in zip(others, trees)]]


# q65 to q68 and q71 fit the default models, but 30 of the 200 boosted trees: each takes about ten passes. Queries that
# need several models or any model fit fewer trees still.
MODELS = _with_trees(100, 30, 30)
QUICK = _with_trees(10, 4, 4)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


_features: dict[tuple[str, str], str] = {}


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feature table: built once per application and scale, like any table of the store."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _features:
        path = scratch_path(spark, "features_daily")
        sinks.write_features(build_features(views.accidents(spark, sf_dir), cluster_method="cells"), path)
        _features[key] = path
    return scans.parquet_table(spark, _features[key], schemas.FEATURES).select(*schemas.FEATURES.names)


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day: a long date column with gaps, for the calendar queries."""
    orders = views.table(spark, sf_dir, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("orders"))


def order_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.column_bounds(views.table(spark, sf_dir, "orders"), "o_orderdate")


def with_orders(days: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = days.join(order_days(spark, sf_dir), "date", "left")
    return joined.withColumn("orders", F.coalesce("orders", F.lit(0)))


def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.column_bounds(views.accidents(spark, sf_dir), "timestamp")


def event_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = locations.distinct_locations(views.accidents(spark, sf_dir))
    return grid.with_location_id(grid.hourly_grid(places, event_bounds(spark, sf_dir)))


# --- sources -----------------------------------------------------------------------------------


@query
def q01_csv_event_scan(spark, sf_dir):
    path = scratch_path(spark, "raw-events")
    views.raw(spark, sf_dir).write.option("header", True).csv(path)
    return scans.csv_events(spark, path)


@query
def q02_event_scan(spark, sf_dir):
    return scans.event_scan(views.accidents(spark, sf_dir))


@query
def q02_event_scan_summary(spark, sf_dir):
    return scans.event_scan_summary(views.accidents(spark, sf_dir))


@query
def q03_calendar_scan(spark, sf_dir):
    table = stage(cal.build_calendar(order_bounds(spark, sf_dir)), "calendar")
    return scans.calendar_scan(with_orders(table, spark, sf_dir))


@query
def q04_sql_read(spark, sf_dir):
    text = (
        "SELECT event_type, count(*) AS events, round(avg(value), 6) AS mean_value "
        "FROM {events} WHERE value >= :least GROUP BY event_type"
    )
    return scans.read_sql(spark, text, {"least": 10.0}, events=views.table(spark, sf_dir, "events"))


@query
def q05_features_for_day(spark, sf_dir):
    day = scoring.features_for_day(feature_table(spark, sf_dir), DAY)
    return rounded(day.select(*ROW_KEY, "temperature_f", TARGET), "temperature_f")


@query
def q05_features_for_hours(spark, sf_dir):
    return scoring.features_for_day(feature_table(spark, sf_dir), DAY, [7, 8, 17]).select(*ROW_KEY, "road_type", TARGET)


@query
def q06_table_facts(spark, sf_dir):
    def facts(name: str, column: str) -> DataFrame:
        df = views.table(spark, sf_dir, name)
        view = f"riskgrid_{name}"
        df.createOrReplaceTempView(view)
        found = scans.table_exists(spark, view)
        return scans.table_facts(spark.table(view), column).select(
            F.lit(name).alias("table_name"), F.lit(found).alias("table_exists"), "row_count", "latest_date"
        )

    return facts("events", "ts").unionByName(facts("orders", "o_orderdate")).unionByName(
        facts("lineitem", "l_shipdate")
    )


# --- sinks -------------------------------------------------------------------------------------


@query
def q07_insert_ignore(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)
    path = scratch_path(spark, "accidents")
    sinks.truncate_and_load(accidents.where("weather_condition = 'Clear'"), path)
    later = F.col("timestamp") + F.expr("interval 1 hour")
    repeated = accidents.where("weather_condition = 'Light Snow'").withColumn("timestamp", later)
    incoming = accidents.unionByName(repeated)
    for _ in range(2):
        sinks.insert_ignore(incoming, path)
    return scans.parquet_table(spark, path).select("accident_id", "timestamp", "severity", "weather_condition")


@query
def q08_write_policy(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)

    def outcome(policy: str) -> DataFrame:
        path = scratch_path(spark, f"policy-{policy}")
        sinks.write_table(accidents.where("weather_condition = 'Clear'"), path, "fail")
        sinks.write_table(accidents, path, policy)
        return scans.parquet_table(spark, path).agg(
            F.lit(policy).alias("policy"), F.count(F.lit(1)).alias("rows"), F.sum("severity").alias("severity")
        )

    def into_empty(policy: str) -> DataFrame:
        path = scratch_path(spark, f"empty-{policy}")
        sinks.write_table(accidents.limit(0), path)
        sinks.write_table(accidents, path, policy)
        return scans.parquet_table(spark, path).agg(
            F.lit(f"{policy}, empty").alias("policy"), F.count(F.lit(1)).alias("rows"), F.sum("severity").alias("severity")
        )

    found = [outcome(p) for p in ("append", "replace", "cancel")] + [into_empty(p) for p in ("cancel", "fail")]
    return reduce(DataFrame.unionByName, found)


@query
def q09_key_violations(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)
    predictions = views.predictions(spark, sf_dir)

    def check(name: str, df: DataFrame, key: list[str]) -> DataFrame:
        found = scans.key_violations(df, key)
        return found.select(F.lit(name).alias("table_name"), F.concat_ws("|", *key).alias("key"), "rows")

    clusters = locations.cell_clusters(accidents, 1.0)
    monitored = metrics.monitoring(predictions, feature_table(spark, sf_dir), TARGET)
    tables = {
        "accidents": accidents,
        "calendar": cal.build_calendar(order_bounds(spark, sf_dir)),
        "features_daily": feature_table(spark, sf_dir),
        "predictions": predictions,
        "model_metadata": views.metadata(spark, sf_dir),
        "monitoring_metrics": monitored,
        "location_clusters": locations.cluster_summary(accidents, clusters),
    }
    checks = [check(name, df, schemas.TABLE_KEYS[name]) for name, df in tables.items()]
    # Not a key: shows that violations are found.
    checks.append(check("place_hours", wx.with_place_hour(accidents), wx.PLACE_HOUR))
    return reduce(DataFrame.unionByName, checks)


@query
def q10_truncate_and_load(spark, sf_dir):
    path = scratch_path(spark, "calendar")
    days = with_orders(cal.build_calendar(order_bounds(spark, sf_dir)), spark, sf_dir)
    for _ in range(2):
        sinks.truncate_and_load(days, path)
    return scans.parquet_table(spark, path).select("date", "is_holiday", "orders")


@query
def q11_features_to_parquet(spark, sf_dir):
    path = scratch_path(spark, "features-copy")
    table = feature_table(spark, sf_dir)
    sinks.write_features(table, path, rows=table.count())
    return scans.parquet_table(spark, path, schemas.FEATURES).select(*ROW_KEY, "accidents_last_24h", TARGET)


@query
def q12_generic_write(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir).select("accident_id", "latitude", "severity")
    path, csv_path = scratch_path(spark, "generic"), scratch_path(spark, "bulk")
    for policy in ("fail", "append", "replace", "append"):
        sinks.write_table(accidents, path, policy)
    for _ in range(2):
        sinks.append_csv(accidents, csv_path)
    bulk = spark.read.schema(accidents.schema).csv(csv_path)
    total = [F.count(F.lit(1)).alias("rows"), F.sum("severity").alias("severity"), F.sum("latitude").alias("latitude")]
    table = scans.parquet_table(spark, path)
    return table.agg(F.lit("table").alias("sink"), *total).unionByName(bulk.agg(F.lit("bulk").alias("sink"), *total))


@query
def q13_replace_day(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    predictions = views.predictions(spark, sf_dir)
    sinks.replace_days(predictions, path)
    halved = predictions.where(F.col("prediction_date") == F.lit(DAY).cast("date"))
    halved = halved.withColumn("risk_score", F.col("risk_score") / 2)
    halved = halved.withColumn("risk_category", risk_category(F.col("risk_score")))
    for _ in range(2):
        sinks.replace_days(halved, path)
    stored = scans.parquet_table(spark, path)
    return rounded(stored.select(*schemas.PREDICTIONS.names[:3], "risk_score", "risk_category"), "risk_score")


@query
def q14_prediction_files(spark, sf_dir):
    path = scratch_path(spark, "prediction-files")
    predictions = views.predictions(spark, sf_dir).withColumn("features", as_json(["latitude"]))
    sinks.write_prediction_files(predictions, path, "csv")
    stored = spark.read.option("header", True).csv(path)
    return stored.select(
        F.col("prediction_date").cast("date"),
        F.col("prediction_hour").cast("int"),
        "location_id",
        F.round(F.col("risk_score").cast("double"), 6).alias("risk_score"),
        "risk_category",
        "model_version",
    )


@query
def q15_point_geometry(spark, sf_dir):
    placed = sinks.with_point(views.accidents(spark, sf_dir))
    return placed.select("accident_id", "location.lon", "location.lat", "location.srid")


@query
def q16_model_save_load(spark, sf_dir):
    # The SQL counterpart counts the rows of a sample.
    data = training_set(sampling.training_sample(feature_table(spark, sf_dir)))
    fitted = training.fit(data.vectors.where("split = 'train'"), QUICK[0], rows=data.rows["train"])
    path = scratch_path(spark, "model")
    models.save_model(models.TrainedModel("logistic_regression", "v1", fitted, data.names, data.categories), path)
    loaded = models.load_model(spark, path)
    both = training.with_probability(loaded.model, data.vectors, "loaded").drop(
        "rawPrediction", "probability", "prediction"
    )
    both = training.with_probability(fitted, both, "fitted")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("loaded") != F.col("fitted")).alias("different_scores")
    )


# --- cleaning ----------------------------------------------------------------------------------


def _renamed(spark, sf_dir):
    return cleaning.rename_columns(views.raw(spark, sf_dir))


@query
def q17_rename_columns(spark, sf_dir):
    return _renamed(spark, sf_dir)


@query
def q18_required_columns(spark, sf_dir):
    return cleaning.require_columns(_renamed(spark, sf_dir)).select(*schemas.REQUIRED_COLUMNS)


@query
def q19_drop_missing_required(spark, sf_dir):
    return cleaning.drop_missing_required(_renamed(spark, sf_dir)).select(*schemas.REQUIRED_COLUMNS)


@query
def q20_parse_times(spark, sf_dir):
    return cleaning.parse_times(_renamed(spark, sf_dir)).select("accident_id", "timestamp")


@query
def q21_valid_coordinates(spark, sf_dir):
    return cleaning.keep_valid_coordinates(_renamed(spark, sf_dir)).select("accident_id", "latitude", "longitude")


@query
def q22_default_flags(spark, sf_dir):
    return cleaning.default_flags(_renamed(spark, sf_dir)).select("accident_id", *schemas.FLAG_COLUMNS)


@query
def q23_coerce_measures(spark, sf_dir):
    return cleaning.coerce_measures(_renamed(spark, sf_dir)).select("accident_id", *schemas.MEASURE_COLUMNS)


@query
def q24_default_severity(spark, sf_dir):
    return cleaning.default_severity(_renamed(spark, sf_dir)).select("accident_id", "severity")


@query
def q25_normalize_texts(spark, sf_dir):
    return cleaning.normalize_texts(_renamed(spark, sf_dir)).select("accident_id", *schemas.TEXT_COLUMNS)


@query
def q26_sort_by_time(spark, sf_dir):
    return cleaning.sort_by_time(cleaning.clean(views.raw(spark, sf_dir)))


@query
def q27_table_columns(spark, sf_dir):
    extra = views.raw(spark, sf_dir).withColumns({"Humidity(%)": F.lit("NaN"), "Unknown": F.lit(1)})
    return cleaning.to_table_columns(cleaning.clean(extra))


@query
def q28_cleaning_summary(spark, sf_dir):
    return cleaning.cleaning_summary(views.raw(spark, sf_dir))


# --- calendar ----------------------------------------------------------------------------------


@query
def q29_date_spine(spark, sf_dir):
    return with_orders(cal.date_spine(order_bounds(spark, sf_dir)), spark, sf_dir)


@query
def q30_date_parts(spark, sf_dir):
    spine = with_orders(cal.date_spine(order_bounds(spark, sf_dir)), spark, sf_dir)
    return cal.with_date_parts(spine)


@query
def q31_holidays(spark, sf_dir):
    bounds = order_bounds(spark, sf_dir)
    spine = with_orders(cal.date_spine(bounds), spark, sf_dir)
    return cal.with_holidays(spine, cal.holidays(bounds))


# --- grid and places ---------------------------------------------------------------------------


@query
def q32_location_key(spark, sf_dir):
    return with_location_key(views.accidents(spark, sf_dir)).select("accident_id", *KEY)


@query
def q33_distinct_locations(spark, sf_dir):
    return locations.with_degrees(locations.distinct_locations(views.accidents(spark, sf_dir)))


@query
def q34_location_sample(spark, sf_dir):
    return locations.sample_locations(locations.distinct_locations(views.accidents(spark, sf_dir)), 10)


@query
def q34_listed_locations(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)
    places = locations.listed_locations(spark, [(25.0, -120.0), (25.5, -120.0), (26.0, -119.75)])
    return grid.with_history(locations.with_degrees(places), accidents)


@query
def q35_hourly_grid(spark, sf_dir):
    return event_grid(spark, sf_dir).select("feature_date", "hour", "latitude", "longitude", "feature_datetime")


@query
def q36_grid_range(spark, sf_dir):
    return event_bounds(spark, sf_dir)


@query
def q37_kmeans_clusters(spark, sf_dir):
    """What must hold for any clustering: every place has one cluster, ids are in range, and the cost of the clusters,
    added up anew from the positions, is that of the best of all restarts."""
    accidents = views.accidents(spark, sf_dir)
    found, fitted, positions = locations.kmeans_with_costs(accidents)
    weighed = lambda c: F.sum(F.col("events") * F.col(c)) / F.sum("events")
    centres = positions.groupBy("cluster_id").agg(weighed("latitude").alias("x"), weighed("longitude").alias("y"))
    apart = (F.col("latitude") - F.col("x")) ** 2 + (F.col("longitude") - F.col("y")) ** 2
    cost = positions.join(centres, "cluster_id").agg(F.sum(F.col("events") * apart)).scalar()
    return found.agg(
        F.max(cost <= F.lit(fitted.cost * (1 + 1e-9))).alias("cost_of_best_restart"),
        F.lit(len(fitted.costs)).alias("restarts"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(*KEY).alias("places"),
        F.count_if(~F.col("cluster_id").between(0, locations.CLUSTERS - 1)).alias("out_of_range"),
        (F.count_distinct("cluster_id") > 1).alias("several_clusters"),
    )


@query
def q38_cell_clusters(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)
    clusters = locations.cell_clusters(accidents, 1.0)
    return locations.with_degrees(clusters).select("latitude", "longitude", "cluster_id")


@query
def q39_location_cluster_map(spark, sf_dir):
    # Severity stands in for a cluster that changes from event to event at one place.
    events = with_location_key(views.accidents(spark, sf_dir))
    sightings = events.select(*KEY, F.col("timestamp").alias("last_seen"), F.col("severity").alias("cluster_id"))
    return locations.last_cluster_by_location(sightings)


@query
def q40_calendar_join(spark, sf_dir):
    calendar = cal.build_calendar(event_bounds(spark, sf_dir))
    joined = grid.join_calendar(event_grid(spark, sf_dir), calendar)
    return joined.select(*ROW_KEY, *grid.CALENDAR_COLUMNS)


@query
def q41_rush_hour(spark, sf_dir):
    return grid.with_rush_hour(event_grid(spark, sf_dir)).select(*ROW_KEY, "is_rush_hour")


def _weather(spark, sf_dir):
    return wx.weather_by_hour(views.accidents(spark, sf_dir))


@query
def q42_weather_medians(spark, sf_dir):
    return rounded(_weather(spark, sf_dir).drop("weather_condition"), *schemas.WEATHER_COLUMNS)


@query
def q42_weather_medians_split(spark, sf_dir):
    """The same medians by brackets and slices, the route of the global medians."""
    events = wx.with_place_hour(views.accidents(spark, sf_dir))
    medians = exact_medians(events, wx.PLACE_HOUR, schemas.WEATHER_COLUMNS)
    modes = exact_modes(events, wx.PLACE_HOUR, "weather_condition")
    counts = events.groupBy(*wx.PLACE_HOUR).agg(F.count(F.lit(1)).alias("event_count"))
    weather = counts.join(medians, wx.PLACE_HOUR, "left").join(modes, wx.PLACE_HOUR, "left")
    return rounded(weather, *schemas.WEATHER_COLUMNS)


@query
def q43_weather_mode(spark, sf_dir):
    return _weather(spark, sf_dir).select(*wx.PLACE_HOUR, "weather_condition")


def _grid_weather(spark, sf_dir, hours):
    places = locations.distinct_locations(views.accidents(spark, sf_dir))
    return grid.with_location_id(win.grid_weather(places, hours, event_bounds(spark, sf_dir)))


@query
def q44_weather_join(spark, sf_dir):
    joined = _grid_weather(spark, sf_dir, _weather(spark, sf_dir))
    picked = joined.select(*ROW_KEY, *schemas.WEATHER_COLUMNS, "weather_condition")
    return rounded(picked, *schemas.WEATHER_COLUMNS)


@query
def q45_median_imputation(spark, sf_dir):
    hours = place_hours(views.accidents(spark, sf_dir))
    filled = wx.fill_with(_grid_weather(spark, sf_dir, hours), grid_medians(hours))
    return rounded(filled.select(*ROW_KEY, *schemas.WEATHER_COLUMNS), *schemas.WEATHER_COLUMNS)


@query
def q45_global_medians(spark, sf_dir):
    columns = schemas.WEATHER_COLUMNS
    return rounded(exact_medians(views.accidents(spark, sf_dir), [], columns), *columns)


@query
def q46_severe_weather(spark, sf_dir):
    flagged = wx.with_severe_flag(views.accidents(spark, sf_dir))
    return flagged.select("accident_id", "weather_condition", "is_severe_weather")


def _place_grid(spark, sf_dir, places):
    """The grid of places that already carry their columns: joined before it grows."""
    return grid.with_location_id(grid.hourly_grid(places, event_bounds(spark, sf_dir)))


@query
def q47_cluster_lookup(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)
    clusters = locations.cell_clusters(accidents, 1.0)
    places = locations.with_cluster(locations.distinct_locations(accidents), clusters)
    return _place_grid(spark, sf_dir, places).select(*ROW_KEY, "cluster_id")


@query
def q48_historical_count(spark, sf_dir):
    places = locations.location_counts(views.accidents(spark, sf_dir))
    return _place_grid(spark, sf_dir, places).select(*ROW_KEY, "accident_freq_historical")


@query
def q48_historical_count_as_of(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)
    places = grid.with_history(locations.distinct_locations(accidents), accidents, as_of=DAY)
    return _place_grid(spark, sf_dir, places).select(*ROW_KEY, "accident_freq_historical")


@query
def q49_road_type(spark, sf_dir):
    places = locations.location_counts(views.accidents(spark, sf_dir))
    # Every place has the same number of grid rows, so the quartiles over places are those over rows
    # once each place counts that often.
    days = event_bounds(spark, sf_dir).select((F.date_diff("end_date", "start_date") + 1).alias("days")).scalar()
    typed = grid.with_road_type(places, grid.road_cutoffs(places, weight=days * 24))
    return _place_grid(spark, sf_dir, typed).select(*ROW_KEY, "accident_freq_historical", "road_type")


def _window_grid(spark, sf_dir, windows):
    accidents = views.accidents(spark, sf_dir)
    hours = wx.hour_counts(accidents)
    places = locations.distinct_locations(accidents)
    counted = win.grid_window_counts(places, hours, event_bounds(spark, sf_dir), windows)
    return grid.with_location_id(counted)


@query
def q50_trailing_counts(spark, sf_dir):
    counted = _window_grid(spark, sf_dir, win.TRAILING).withColumns(win.lag_columns())
    names = ["accidents_last_24h", "accidents_last_7days", "rolling_7day_accidents", "rolling_30day_accidents"]
    return counted.select(*ROW_KEY, *names)


@query
def q50_trailing_counts_late_grid(spark, sf_dir):
    """A grid that starts inside the history: events before it still count."""
    accidents = views.accidents(spark, sf_dir)
    bounds = cal.date_bounds(spark, "2024-01-12", "2024-01-20")
    places = grid.hourly_grid(locations.distinct_locations(accidents), bounds)
    counted = win.add_lag_features(grid.with_location_id(places), wx.hour_counts(accidents))
    return counted.select(*ROW_KEY, "accidents_last_24h", "accidents_last_7days", "rolling_30day_accidents")


@query
def q51_moving_averages(spark, sf_dir):
    counted = _window_grid(spark, sf_dir, win.TRAILING).withColumns(win.lag_columns())
    return counted.select(*ROW_KEY, "moving_avg_3day", "moving_avg_7day", "moving_avg_30day")


@query
def q52_forward_label(spark, sf_dir):
    counted = _window_grid(spark, sf_dir, [win.ahead()])
    return counted.select(*ROW_KEY, win.label_column().alias(TARGET))


@query
def q52_forward_label_6h(spark, sf_dir):
    labelled = win.add_label(event_grid(spark, sf_dir), wx.hour_counts(views.accidents(spark, sf_dir)), 6)
    return labelled.select(*ROW_KEY, TARGET)


@query
def q53_label_rate(spark, sf_dir):
    return rounded(win.label_rate(feature_table(spark, sf_dir)), "positive_rate")


@query
def q54_location_id(spark, sf_dir):
    placed = grid.with_location_id(with_location_key(views.accidents(spark, sf_dir)))
    return placed.select("accident_id", "location_id")


@query
def q55_feature_table(spark, sf_dir):
    features = build_features(views.accidents(spark, sf_dir), cluster_method="cells")
    return rounded(features, *schemas.WEATHER_COLUMNS)


# --- training set ------------------------------------------------------------------------------


@query
def q56_class_sample(spark, sf_dir):
    sample = sampling.class_sample(feature_table(spark, sf_dir), TARGET, 1, sampling.POSITIVE_CAP)
    return sample.select(*ROW_KEY, TARGET)


@query
def q57_training_sample(spark, sf_dir):
    return sampling.training_sample(feature_table(spark, sf_dir)).select(*ROW_KEY, TARGET)


@query
def q58_shuffled_rows(spark, sf_dir):
    return sampling.shuffled(feature_table(spark, sf_dir).select(*ROW_KEY, TARGET))


@query
def q59_stratified_split(spark, sf_dir):
    return sampling.stratified_split(feature_table(spark, sf_dir)).select(*ROW_KEY, TARGET, "split")


@query
def q60_split_summary(spark, sf_dir):
    summary = sampling.split_summary(sampling.stratified_split(feature_table(spark, sf_dir)))
    return rounded(summary, "positive_rate")


@query
def q61_feature_columns(spark, sf_dir):
    table = feature_table(spark, sf_dir)
    names = encoding.feature_columns(table.columns)
    counts = [F.count(name).alias(name) for name in names]
    return table.agg(*counts)


@query
def q62_one_hot(spark, sf_dir):
    table = sampling.stratified_split(feature_table(spark, sf_dir))
    categories = encoding.vocabulary(table.where("split = 'train'"))
    encoded = encoding.one_hot(table, categories)
    return encoded.select(*ROW_KEY, *[c for c in encoded.columns if c.startswith("road_type_")])


@query
def q63_vector_assembly(spark, sf_dir):
    """Sum of every vector position: nulls count as 0."""
    table = feature_table(spark, sf_dir).withColumn("humidity", F.nullif("humidity", F.lit(50.0)))
    names = [c for c in encoding.feature_columns(table.columns) if c != "road_type"]
    vectors = encoding.assemble(table, names)
    cells = vectors.select(F.posexplode(vector_to_array("features")).alias("position", "value"))
    totals = cells.groupBy("position").agg(F.round(F.sum("value"), 3).alias("total"))
    return totals.withColumn("feature", F.element_at(F.lit(names), F.col("position") + 1)).select("feature", "total")


@query
def q64_class_weights(spark, sf_dir):
    table = feature_table(spark, sf_dir)
    weighed = sampling.with_positive_weight(sampling.with_balanced_weight(table), 5.0, out="boosted_weight")
    return rounded(weighed.select(*ROW_KEY, "weight", "boosted_weight"), "weight")


# --- models ------------------------------------------------------------------------------------


def _train_one(spark, sf_dir, spec, whole=False):
    # The bounds cut the train split alone: validation and test rows are those of the whole table.
    bounds = (None, None) if whole else (POSITIVES, NEGATIVES)
    data = training_set(feature_table(spark, sf_dir), *bounds)
    fitted = training.fit(data.vectors.where("split = 'train'").drop("values"), spec, rows=data.rows["train"])
    return data, fitted


def _report(spark, sf_dir, spec, whole=False):
    """What must hold for any fit: rows of each split, no score outside [0, 1], and better ranks than chance."""
    data, fitted = _train_one(spark, sf_dir, spec, whole)
    scored = stage(training.with_probability(fitted, data.vectors).select("split", TARGET, "p"), "scored-rows")
    counts = scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("p").between(0.0, 1.0) | F.isnan("p")).alias("bad_scores")
    )
    ranked = metrics.binary_metrics(scored, TARGET, "p", ["split"])
    return counts.join(ranked.select("split", (F.col("auc") > 0.5).alias("auc_above_half")), "split")


@query
def q65_logistic_regression(spark, sf_dir):
    return _report(spark, sf_dir, MODELS[0], whole=True)


@query
def q66_random_forest(spark, sf_dir):
    return _report(spark, sf_dir, MODELS[1], whole=True)


@query
def q67_boosted_trees_weighted(spark, sf_dir):
    return _report(spark, sf_dir, MODELS[2])


@query
def q68_boosted_trees_balanced(spark, sf_dir):
    return _report(spark, sf_dir, MODELS[3], whole=True)


@query
def q69_binary_metrics(spark, sf_dir):
    found = metrics.binary_metrics(views.scored(spark, sf_dir))
    return rounded(found, "auc", "precision", "recall", "f1", "accuracy")


@query
def q69_binary_metrics_by_group(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select(
        "event_type", F.expr("cast(user_id % 3 = 0 as int)").alias("y"), F.expr("least(1e0, value / 100e0)").alias("p")
    )
    found = metrics.binary_metrics(events, by=["event_type"])
    return rounded(found, "auc", "precision", "recall", "f1", "accuracy")


@query
def q70_feature_importance(spark, sf_dir):
    data, fitted = _train_one(spark, sf_dir, QUICK[1])
    found = training.feature_importance(fitted, data.names)
    return found.agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if((F.col("importance") < 0) | F.isnan("importance")).alias("bad_values"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


@query
def q71_best_model(spark, sf_dir):
    newest = scoring.latest_metadata(views.metadata(spark, sf_dir)).withColumnRenamed("auc_score", "auc")
    return metrics.best_model(newest).select("model_name", "model_version", "auc")


@query
def q71_train_and_compare(spark, sf_dir):
    _, report = train_models(
        feature_table(spark, sf_dir), "v1", RUN_TIME, MODELS, positives=POSITIVES, negatives=NEGATIVES
    )
    best = best_by_test_auc(report).select(F.col("auc").alias("best")).scalar()
    return report.groupBy("split").agg(
        F.count(F.lit(1)).alias("models"),
        F.count_if((F.col("split") == "test") & (F.col("auc") > best)).alias("better_than_best"),
        F.count_if(F.col("auc").between(0.0, 1.0)).alias("valid_auc"),
    )


@query
def q72_model_metadata(spark, sf_dir):
    found = metrics.binary_metrics(views.scored(spark, sf_dir)).first().asDict()
    path = scratch_path(spark, "model_metadata")
    row = sinks.metadata_row(spark, "scored", "v1", RUN_TIME, found, ["n_chars"])
    sinks.append_metadata(row, path)
    stored = scans.parquet_table(spark, path)
    scores = [c for c in stored.columns if c.endswith("_score")]
    named = stored.withColumn("features_used", F.concat_ws(",", "features_used"))
    return rounded(named.select("model_name", "model_version", "training_date", *scores, "features_used"), *scores)


# --- scoring -----------------------------------------------------------------------------------


@query
def q73_latest_metadata(spark, sf_dir):
    return scoring.latest_metadata(views.metadata(spark, sf_dir))


@query
def q73_latest_metadata_of_one(spark, sf_dir):
    return scoring.latest_metadata(views.metadata(spark, sf_dir), "2-HIGH")


@query
def q74_align_features(spark, sf_dir):
    names = ["humidity", "hour", "not_in_table", "accidents_last_24h", "is_holiday"]
    table = feature_table(spark, sf_dir).withColumn("humidity", F.nullif("humidity", F.lit(50.0)))
    table = table.withColumn("hour_of_day", F.col("hour"))
    aligned = encoding.align_features(table, names, ["location_id", "feature_date", "hour_of_day"])
    return rounded(aligned, "humidity")


@query
def q75_score_rows(spark, sf_dir):
    table = feature_table(spark, sf_dir)
    data, fitted = _train_one(spark, sf_dir, QUICK[0])
    trained = models.TrainedModel("logistic_regression", "v1", fitted, data.names, data.categories)
    return _prediction_facts(predictions_of(table, trained))


def _prediction_facts(predictions):
    """Rows per day, categories that disagree with their score, and repeated keys."""
    expected = F.when(F.col("risk_score") >= 0.75, "High").when(F.col("risk_score") >= 0.5, "Medium").otherwise("Low")
    return predictions.groupBy("prediction_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("risk_category") != expected).alias("wrong_category"),
        F.count_if(~F.col("risk_score").between(0.0, 1.0)).alias("bad_scores"),
        (F.count(F.lit(1)) - F.count_distinct("prediction_hour", "location_id")).alias("repeated"),
    )


def _unscored(spark, sf_dir):
    return views.predictions(spark, sf_dir).drop("risk_category").withColumnsRenamed(
        {"prediction_date": "feature_date", "prediction_hour": "hour"}
    )


@query
def q76_risk_category(spark, sf_dir):
    scored = _unscored(spark, sf_dir).withColumn("risk_category", risk_category(F.col("risk_score"), 0.25, 0.5))
    return rounded(scored.select("location_id", "feature_date", "hour", "risk_score", "risk_category"), "risk_score")


@query
def q77_prediction_rows(spark, sf_dir):
    return rounded(scoring.as_predictions(_unscored(spark, sf_dir)).drop("features"), "risk_score")


@query
def q78_feature_documents(spark, sf_dir):
    names = ["latitude", "hour", "model_version"]
    documents = scoring.as_predictions(_unscored(spark, sf_dir), feature_names=names)
    parsed = F.from_json("features", "latitude double, hour int, model_version string")
    return documents.select(*schemas.PREDICTIONS.names[:3], parsed.alias("document")).select(
        *schemas.PREDICTIONS.names[:3],
        F.col("document.latitude").alias("document_latitude"),
        F.col("document.hour").alias("document_hour"),
        F.col("document.model_version").alias("document_version"),
    )


@query
def q79_category_counts(spark, sf_dir):
    return scoring.category_counts(views.predictions(spark, sf_dir))


@query
def q80_high_risk_zones(spark, sf_dir):
    zones = scoring.high_risk_zones(views.predictions(spark, sf_dir))
    return rounded(zones.select(*schemas.PREDICTIONS.names[:3], "risk_score"), "risk_score")


@query
def q81_daily_scoring(spark, sf_dir):
    table = feature_table(spark, sf_dir)
    data, fitted = _train_one(spark, sf_dir, QUICK[0])
    trained = models.TrainedModel("logistic_regression", "v1", fitted, data.names, data.categories)
    path, files = scratch_path(spark, "predictions"), scratch_path(spark, "prediction-files")
    zones = score_day(table, trained, DAY, path, files)
    stored = scans.parquet_table(spark, path, schemas.PREDICTIONS)
    return _prediction_facts(stored).withColumn("few_zones", zones.agg(F.count(F.lit(1)) <= 10).scalar())


# --- serving -----------------------------------------------------------------------------------


@query
def q82_predictions_by_date(spark, sf_dir):
    return rounded(serving.predictions_by_date(views.predictions(spark, sf_dir), DAY), "risk_score")


@query
def q83_predictions_by_location(spark, sf_dir):
    return rounded(serving.predictions_by_location(views.predictions(spark, sf_dir), "25.5_-119.75"), "risk_score")


@query
def q83_predictions_by_location_and_date(spark, sf_dir):
    found = serving.predictions_by_location(views.predictions(spark, sf_dir), "25.5_-119.75", DAY)
    return rounded(found, "risk_score")


@query
def q84_high_risk_zones(spark, sf_dir):
    return rounded(serving.high_risk_zones(views.predictions(spark, sf_dir), DAY, 20, 0.5), "risk_score")


@query
def q84_high_risk_report(spark, sf_dir):
    report = serving.high_risk_report(views.predictions(spark, sf_dir), DAY, 20, 0.5)
    zones = report.select("prediction_date", "total_zones", F.posexplode("zones").alias("position", "zone"))
    return zones.select("prediction_date", "total_zones", "position", "zone.location_id", "zone.prediction_hour")


@query
def q85_statistics(spark, sf_dir):
    return serving.statistics(views.predictions(spark, sf_dir))


# --- end to end and second tier ----------------------------------------------------------------


@query
def q86_end_to_end_run(spark, sf_dir):
    root = scratch_path(spark, "project")
    views.raw(spark, sf_dir).write.option("header", True).csv(f"{root}/raw")
    project = endtoend.Project(
        root, f"{root}/raw", DAY, "v1", RUN_TIME, model_name="lightgbm", specs=QUICK,
        positives=POSITIVES, negatives=NEGATIVES,
    )
    endtoend.run(spark, project)
    features = scans.parquet_table(spark, project.path("features_daily"), schemas.FEATURES)
    stored = scans.parquet_table(spark, project.path("predictions"), schemas.PREDICTIONS)
    calendar_null = F.col("day_of_week").isNull() | F.col("month").isNull() | F.col("is_holiday").isNull()
    events = scans.parquet_table(spark, project.path("accidents"), schemas.ACCIDENTS)
    models_kept = scans.parquet_table(spark, project.path("model_metadata"), schemas.MODEL_METADATA)
    return _prediction_facts(stored).withColumns(
        {
            "events": events.agg(F.count(F.lit(1))).scalar(),
            "grid_days": features.agg(F.count_distinct("feature_date")).scalar(),
            "null_calendar_rows": features.agg(F.count_if(calendar_null)).scalar(),
            "models": models_kept.agg(F.count(F.lit(1))).scalar(),
        }
    )


@query
def q87_monitoring(spark, sf_dir):
    daily = metrics.monitoring(views.predictions(spark, sf_dir), feature_table(spark, sf_dir), TARGET)
    return rounded(daily, "auc_score", "precision_score", "recall_score", "f1_score")


@query
def q88_cluster_summary(spark, sf_dir):
    accidents = views.accidents(spark, sf_dir)
    summary = locations.cluster_summary(accidents, locations.cell_clusters(accidents, 1.0))
    return rounded(summary, "centroid_latitude", "centroid_longitude", "avg_severity")


@query
def q89_time_split(spark, sf_dir):
    split = sampling.time_split(feature_table(spark, sf_dir), "2024-01-20", "2024-01-25", "2024-01-28")
    return split.select(*ROW_KEY, "split")


@query
def q90_undersample(spark, sf_dir):
    return sampling.undersample(feature_table(spark, sf_dir)).select(*ROW_KEY, TARGET)


@query
def q91_quality_gate(spark, sf_dir):
    by_source = metrics.binary_metrics(views.scored(spark, sf_dir), by=["source"])
    passed = metrics.quality_gate(by_source, min_auc=0.4, min_recall=0.4, min_precision=0.6)
    return rounded(passed.select("source", "auc", "recall", "precision"), "auc", "recall", "precision")


@query
def q92_cross_validation(spark, sf_dir):
    data = training_set(feature_table(spark, sf_dir), POSITIVES, NEGATIVES)
    train = data.vectors.where("split = 'train'")
    search = training.cross_validate(
        train, QUICK[0], {"regParam": [0.0, 0.1]}, folds=training.FOLDS, rows=data.rows["train"]
    )
    scores = [(float(m[next(iter(m))]), float(a)) for m, a in zip(search.getEstimatorParamMaps(), search.avgMetrics)]
    found = spark.createDataFrame(scores, "reg_param double, mean_auc double")
    return found.select("reg_param", (F.col("mean_auc") > 0.5).alias("auc_above_half"))
