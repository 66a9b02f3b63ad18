"""Table schemas, key columns and the raw column names."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING = StringType()
INT = IntegerType()
DOUBLE = DoubleType()
BOOLEAN = BooleanType()
DATE = DateType()
TIME = TimestampNTZType()
STRINGS = ArrayType(STRING)
POINT = StructType([StructField("lon", DOUBLE), StructField("lat", DOUBLE), StructField("srid", INT)])

# Raw file header -> table column.
RAW_COLUMNS = {
    "ID": "accident_id",
    "Severity": "severity",
    "Start_Time": "timestamp",
    "Start_Lat": "latitude",
    "Start_Lng": "longitude",
    "Distance(mi)": "distance_mi",
    "Temperature(F)": "temperature_f",
    "Wind_Chill(F)": "wind_chill_f",
    "Humidity(%)": "humidity",
    "Pressure(in)": "pressure_in",
    "Visibility(mi)": "visibility_mi",
    "Wind_Speed(mph)": "wind_speed_mph",
    "Precipitation(in)": "precipitation_in",
    "Amenity": "amenity",
    "Bump": "bump",
    "Crossing": "crossing",
    "Give_Way": "give_way",
    "Junction": "junction",
    "No_Exit": "no_exit",
    "Railway": "railway",
    "Roundabout": "roundabout",
    "Station": "station",
    "Stop": "stop",
    "Traffic_Calming": "traffic_calming",
    "Traffic_Signal": "traffic_signal",
    "Turning_Loop": "turning_loop",
    "Weather_Condition": "weather_condition",
    "Wind_Direction": "wind_direction",
    "Sunrise_Sunset": "sunrise_sunset",
    "Civil_Twilight": "civil_twilight",
    "Nautical_Twilight": "nautical_twilight",
    "Astronomical_Twilight": "astronomical_twilight",
    "Street": "street",
    "City": "city",
    "County": "county",
    "State": "state",
    "Zipcode": "zipcode",
    "Country": "country",
    "Timezone": "timezone",
    "Airport_Code": "airport_code",
    "Weather_Timestamp": "weather_timestamp",
}

# Raw headers of the flags.
RAW_FLAGS = [
    "Amenity",
    "Bump",
    "Crossing",
    "Give_Way",
    "Junction",
    "No_Exit",
    "Railway",
    "Roundabout",
    "Station",
    "Stop",
    "Traffic_Calming",
    "Traffic_Signal",
    "Turning_Loop",
]

# Raw headers of the texts.
RAW_TEXTS = [
    "Weather_Condition",
    "Wind_Direction",
    "Sunrise_Sunset",
    "Civil_Twilight",
    "Nautical_Twilight",
    "Astronomical_Twilight",
    "Street",
    "City",
    "County",
    "State",
    "Zipcode",
    "Country",
    "Timezone",
    "Airport_Code",
]

# Columns without which a row is useless.
REQUIRED_COLUMNS = [
    "accident_id",
    "timestamp",
    "latitude",
    "longitude",
]

# Measures of an event.
MEASURE_COLUMNS = [
    "distance_mi",
    "temperature_f",
    "wind_chill_f",
    "humidity",
    "pressure_in",
    "visibility_mi",
    "wind_speed_mph",
    "precipitation_in",
]

FLAG_COLUMNS = [name.lower() for name in RAW_FLAGS]
TEXT_COLUMNS = [name.lower() for name in RAW_TEXTS]

# Weather measures that become features.
WEATHER_COLUMNS = [
    "temperature_f",
    "visibility_mi",
    "precipitation_in",
    "wind_speed_mph",
    "humidity",
    "pressure_in",
]

# The projected event scan: what the feature build reads.
EVENT_COLUMNS = [*REQUIRED_COLUMNS, "severity", *WEATHER_COLUMNS, "weather_condition"]

# Fixed value: the label.
TARGET = "accident_occurred_next_24h"

# The event table.
ACCIDENTS = StructType(
    [
        StructField("accident_id", STRING),
        StructField("timestamp", TIME),
        StructField("latitude", DOUBLE),
        StructField("longitude", DOUBLE),
        StructField("severity", INT),
        StructField("distance_mi", DOUBLE),
        StructField("temperature_f", DOUBLE),
        StructField("wind_chill_f", DOUBLE),
        StructField("humidity", DOUBLE),
        StructField("pressure_in", DOUBLE),
        StructField("visibility_mi", DOUBLE),
        StructField("wind_speed_mph", DOUBLE),
        StructField("precipitation_in", DOUBLE),
        StructField("weather_condition", STRING),
        StructField("wind_direction", STRING),
        StructField("amenity", BOOLEAN),
        StructField("bump", BOOLEAN),
        StructField("crossing", BOOLEAN),
        StructField("give_way", BOOLEAN),
        StructField("junction", BOOLEAN),
        StructField("no_exit", BOOLEAN),
        StructField("railway", BOOLEAN),
        StructField("roundabout", BOOLEAN),
        StructField("station", BOOLEAN),
        StructField("stop", BOOLEAN),
        StructField("traffic_calming", BOOLEAN),
        StructField("traffic_signal", BOOLEAN),
        StructField("turning_loop", BOOLEAN),
        StructField("sunrise_sunset", STRING),
        StructField("civil_twilight", STRING),
        StructField("nautical_twilight", STRING),
        StructField("astronomical_twilight", STRING),
        StructField("street", STRING),
        StructField("city", STRING),
        StructField("county", STRING),
        StructField("state", STRING),
        StructField("zipcode", STRING),
        StructField("country", STRING),
        StructField("timezone", STRING),
        StructField("airport_code", STRING),
        StructField("weather_timestamp", TIME),
        StructField("location", POINT),
    ]
)

# The calendar.
CALENDAR = StructType(
    [
        StructField("date", DATE),
        StructField("year", INT),
        StructField("month", INT),
        StructField("day", INT),
        StructField("day_of_week", INT),
        StructField("day_name", STRING),
        StructField("is_weekend", BOOLEAN),
        StructField("is_holiday", BOOLEAN),
        StructField("holiday_name", STRING),
        StructField("quarter", INT),
        StructField("week_of_year", INT),
    ]
)

# The feature table.
FEATURES = StructType(
    [
        StructField("feature_date", DATE),
        StructField("location_id", STRING),
        StructField("latitude", DOUBLE),
        StructField("longitude", DOUBLE),
        StructField("hour", INT),
        StructField("day_of_week", INT),
        StructField("month", INT),
        StructField("is_weekend", BOOLEAN),
        StructField("is_holiday", BOOLEAN),
        StructField("is_rush_hour", BOOLEAN),
        StructField("temperature_f", DOUBLE),
        StructField("visibility_mi", DOUBLE),
        StructField("precipitation_in", DOUBLE),
        StructField("wind_speed_mph", DOUBLE),
        StructField("humidity", DOUBLE),
        StructField("pressure_in", DOUBLE),
        StructField("weather_condition", STRING),
        StructField("is_severe_weather", BOOLEAN),
        StructField("accident_freq_historical", INT),
        StructField("rolling_7day_accidents", INT),
        StructField("rolling_30day_accidents", INT),
        StructField("cluster_id", INT),
        StructField("road_type", STRING),
        StructField("accidents_last_24h", INT),
        StructField("accidents_last_7days", INT),
        StructField("moving_avg_3day", DOUBLE),
        StructField("moving_avg_7day", DOUBLE),
        StructField("moving_avg_30day", DOUBLE),
        StructField("accident_occurred_next_24h", INT),
    ]
)

# The predictions.
PREDICTIONS = StructType(
    [
        StructField("prediction_date", DATE),
        StructField("prediction_hour", INT),
        StructField("location_id", STRING),
        StructField("latitude", DOUBLE),
        StructField("longitude", DOUBLE),
        StructField("risk_score", DOUBLE),
        StructField("risk_category", STRING),
        StructField("model_version", STRING),
        StructField("features", STRING),
    ]
)

# The models. mlflow_run_id stays null: there is no such server here.
MODEL_METADATA = StructType(
    [
        StructField("model_name", STRING),
        StructField("model_version", STRING),
        StructField("model_type", STRING),
        StructField("training_date", TIME),
        StructField("auc_score", DOUBLE),
        StructField("precision_score", DOUBLE),
        StructField("recall_score", DOUBLE),
        StructField("f1_score", DOUBLE),
        StructField("accuracy_score", DOUBLE),
        StructField("train_samples", INT),
        StructField("val_samples", INT),
        StructField("test_samples", INT),
        StructField("features_used", STRINGS),
        StructField("hyperparameters", STRING),
        StructField("model_path", STRING),
        StructField("mlflow_run_id", STRING),
        StructField("is_production", BOOLEAN),
        StructField("deployed_at", TIME),
    ]
)

# Daily quality.
MONITORING_METRICS = StructType(
    [
        StructField("metric_date", DATE),
        StructField("model_version", STRING),
        StructField("auc_score", DOUBLE),
        StructField("precision_score", DOUBLE),
        StructField("recall_score", DOUBLE),
        StructField("f1_score", DOUBLE),
        StructField("total_predictions", INT),
        StructField("high_risk_predictions", INT),
        StructField("medium_risk_predictions", INT),
        StructField("low_risk_predictions", INT),
        StructField("true_positives", INT),
        StructField("false_positives", INT),
        StructField("true_negatives", INT),
        StructField("false_negatives", INT),
    ]
)

# The clusters.
LOCATION_CLUSTERS = StructType(
    [
        StructField("cluster_id", INT),
        StructField("centroid_latitude", DOUBLE),
        StructField("centroid_longitude", DOUBLE),
        StructField("accident_count", INT),
        StructField("avg_severity", DOUBLE),
    ]
)

# The unique key of each table.
TABLE_KEYS = {
    "accidents": ["accident_id"],
    "calendar": ["date"],
    "weather_daily": ["date", "latitude", "longitude"],
    "features_daily": ["feature_date", "location_id", "hour"],
    "predictions": ["prediction_date", "prediction_hour", "location_id"],
    "model_metadata": ["model_name", "model_version"],
    "monitoring_metrics": ["metric_date", "model_version"],
    "location_clusters": ["cluster_id"],
}
