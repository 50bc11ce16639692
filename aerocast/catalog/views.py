"""Readings tables derived from ``events``: one reading per event, then one per city and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.operators.readings import first_per_key
from aerocast.operators.series import forecast_features
from aerocast.plans.evaluate import persistence_forecast

MEASURED = ["main_aqi", "components_pm2_5", "components_pm10"]
# Cut-offs inside the month that the events cover.
CUTOFF = "2024-01-24 23:59:59"
BASELINE_UNTIL = "2024-01-15 23:59:59"
# Values under this one count as a sensor dropout: the level is missing.
DROPOUT_BELOW = 3.0
# Raw spellings of the station names, by event type; one station is not supported.
STATIONS = {
    "click": " Islamabad",
    "error": "LAHORE",
    "purchase": "karachi ",
    "signup": "Peshawar",
    "view": "Multan",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def reading_columns() -> list[Column]:
    value = F.col("value")
    return [
        F.col("event_type").alias("city"),
        F.timestamp_add("HOUR", F.hour("ts"), F.col("ts").cast("date").cast("timestamp_ntz")).alias("datetime"),
        F.least(F.lit(5.0), F.lit(1.0) + value / F.lit(25.0)).alias("main_aqi"),
        value.alias("components_pm2_5"),
        F.get_json_object("props", "$.k").try_cast("double").alias("components_pm10"),
    ]


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event: several per city and hour."""
    return events(spark, sf_dir).select("event_id", *reading_columns())


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per city and hour, the one with the smallest event id."""
    return first_per_key(raw_readings(spark, sf_dir), order="event_id")


def dropout_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose level is missing where the sensor value is low."""
    level = F.when(F.col("components_pm2_5") >= DROPOUT_BELOW, F.col("main_aqi"))
    return readings(spark, sf_dir).withColumn("main_aqi", level)


def station_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings under raw station names, one of them unsupported."""
    name = F.lit(None).cast("string")
    for kind, station in STATIONS.items():
        name = F.when(F.col("city") == kind, F.lit(station)).otherwise(name)
    return readings(spark, sf_dir).withColumn("city", name)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_features(readings(spark, sf_dir))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with the persistence forecast as the prediction."""
    return persistence_forecast(features(spark, sf_dir))


# Inputs of the trees that SQL grows as well: few values each, so that every split is looked at.
COARSE = ["main_aqi", "main_aqi_lag_1", "main_aqi_lag_2", "main_aqi_lag_3", "hour", "dayofweek", "is_weekend", "city"]
COARSE_DEPTH = 3


def coarse(df: DataFrame) -> DataFrame:
    """Levels rounded down to quarters."""
    return df.withColumns({c: F.floor(F.col(c) * 4) / F.lit(4.0) for c in COARSE if c.startswith("main_aqi")})
