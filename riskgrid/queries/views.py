"""The library's tables, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid import schemas
from riskgrid.functions.risk import risk_category


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _latitude() -> Column:
    return F.expr("25e0 + (user_id % 10) * 0.5e0")


def _longitude() -> Column:
    return F.expr("-120e0 + cast(floor(user_id / 10e0) as double) * 0.25e0")


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("accident_id"),
        F.col("ts").alias("timestamp"),
        _latitude().alias("latitude"),
        _longitude().alias("longitude"),
        F.expr("cast(1 + event_id % 4 as int) as severity"),
        F.expr("case when event_id % 7 = 0 then null else value end as temperature_f"),
        F.expr("cast(event_id % 11 as double) as visibility_mi"),
        F.expr("case when event_id % 3 = 0 then null else (event_id % 5) / 8e0 end as precipitation_in"),
        F.get_json_object("props", "$.k").cast("double").alias("wind_speed_mph"),
        F.expr("cast(event_id % 101 as double) as humidity"),
        F.expr("29e0 + (event_id % 64) / 64e0 as pressure_in"),
        F.expr(
            "case event_type when 'click' then 'Clear' when 'view' then 'Light Snow' "
            "when 'error' then 'Heavy Rain' when 'signup' then 'fog' end as weather_condition"
        ),
    )


#: Raw headers whose texts have rules of their own in ``raw``.
_NAMED = ("ID", "Start_Time", "Start_Lat", "Start_Lng", "Severity", "Temperature(F)", "Junction", "Weather_Condition")


def other_raw_texts() -> dict[str, str]:
    """SQL, as Spark and DuckDB both read it, of the texts under all other raw headers: flags, measures, words, a time."""
    texts = {}
    for i, header in enumerate(h for h in schemas.RAW_COLUMNS if h not in _NAMED):
        if header in schemas.RAW_FLAGS:
            texts[header] = f"case when (event_id + {i}) % 4 = 0 then 'True' when (event_id + {i}) % 3 <> 0 then 'False' end"
        elif header in schemas.RAW_TEXTS:
            texts[header] = f"case when (event_id + {i}) % 5 = 0 then 'nan' else concat('{header[0]}', cast(event_id % {i + 2} as string)) end"
        elif header != "Weather_Timestamp":
            texts[header] = f"case when event_id % {i + 11} = 0 then 'abc' else cast((event_id % 64) / 8e0 as string) end"
    return texts


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as dirty text under all raw file headers."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("ID"),
        F.when(F.expr("event_id % 97 = 0"), "not a time")
        .when(F.expr("event_id % 101 <> 0"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("Start_Time"),
        F.when(F.expr("event_id % 89 = 0"), "95.0").otherwise(_latitude().cast("string")).alias("Start_Lat"),
        _longitude().cast("string").alias("Start_Lng"),
        F.expr("case when event_id % 83 <> 0 then cast(1 + event_id % 4 as string) end as Severity"),
        F.when(F.expr("event_id % 79 = 0"), "abc").otherwise(F.col("value").cast("string")).alias("Temperature(F)"),
        F.expr("case when event_id % 2 = 0 then 'True' when event_id % 3 <> 0 then 'False' end as Junction"),
        F.expr("case when event_type = 'purchase' then 'nan' else event_type end as Weather_Condition"),
        F.when(F.expr("event_id % 13 = 0"), "NaT")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("Weather_Timestamp"),
        *[F.expr(text).alias(header) for header, text in other_raw_texts().items()],
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored row per place and hour that has events; the score needs no model."""
    events = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("prediction_date"),
        F.hour("ts").alias("prediction_hour"),
        F.concat_ws("_", _latitude().cast("string"), _longitude().cast("string")).alias("location_id"),
        _latitude().alias("latitude"),
        _longitude().alias("longitude"),
        F.expr("least(1e0, value / 200e0) as score"),
        F.expr("case when event_id % 2 = 0 then 'v1' else 'v2' end as version"),
    )
    keys = ["prediction_date", "prediction_hour", "location_id", "latitude", "longitude"]
    scored = events.groupBy(*keys).agg(F.max("score").alias("risk_score"), F.max("version").alias("model_version"))
    return scored.withColumn("risk_category", risk_category(F.col("risk_score")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    joined = labels.join(documents, "doc_id")
    return joined.select("doc_id", "source", F.col("quality").alias("y"), F.expr("(n_chars % 1000) / 1000e0 as p"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("model_name"),
        F.col("o_orderkey").cast("string").alias("model_version"),
        F.col("o_orderdate").alias("training_date"),
        F.col("o_totalprice").alias("auc_score"),
    )
