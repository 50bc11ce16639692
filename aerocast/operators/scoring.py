"""Serving rows and prediction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.contract import FEATURES, HORIZON, LAG_STEPS, LAGGED, MODEL_VERSION, POLLUTANTS, ROLL_ROWS, ROLLED
from aerocast.functions.advice import advice_record
from aerocast.functions.calendar import calendar_columns, forecast_time
from aerocast.functions.labels import hazard_text
from aerocast.operators.readings import city_name, coalesce_pollutants

# --- Fixed values: wording of the level scale in a prediction record. ---
SCALE = "OpenWeather 1–5 AQI"
SCALE_TEXT = "1=Good, 2=Fair, 3=Moderate, 4=Poor, 5=Very Poor"


def cold_start_features(df: DataFrame, at: str = "datetime") -> DataFrame:
    """Serving features of single readings without history.

    Lags and rolling means repeat the current value; a missing pollutant counts as 0; the
    calendar comes from the time of the weather observation.
    """
    pollutants = [f"components_{p}" for p in POLLUTANTS if f"components_{p}" in df.columns]
    now = coalesce_pollutants(df.withColumn("city", city_name(F.col("city"))), pollutants)
    copies: dict[str, Column] = {f"{c}_lag_{k}": F.col(c) for c in LAGGED for k in range(1, LAG_STEPS + 1)}
    copies |= {f"{c}_roll{ROLL_ROWS}_mean": F.col(c) for c in ROLLED}
    return now.withColumns({**calendar_columns(F.col(at)), **copies})


def serving_columns(df: DataFrame) -> list[str]:
    """The contract inputs that the frame carries, in contract order."""
    return [c for c in FEATURES if c in df.columns]


def prediction_records(
    scored: DataFrame, model_name: str | None = None, observed: str | None = "datetime", carried: list[str] | None = None
) -> DataFrame:
    """Nested prediction record per scored row.

    Expects ``aqi_3h`` and, where the models gave them, ``hazard_prob`` and ``severity_model``.
    ``model_name`` tells where the severity model is stored; it is recorded where that model chose.
    ``carried`` columns stay beside the record.
    """
    has = set(scored.columns)
    label = hazard_text(F.col("aqi_3h"))
    bucket = F.col("severity_model").cast("int") if "severity_model" in has else None
    current = F.col("main_aqi") if "main_aqi" in has else None
    record = [
        F.col("city"),
        F.struct(
            F.col("aqi_3h"),
            (F.col("hazard_prob") if "hazard_prob" in has else F.lit(None).cast("double")).alias("hazard_prob"),
            label.alias("hazard_label"),
        ).alias("prediction"),
    ]
    if observed and observed in has:
        record.append(
            F.struct(
                (current if current is not None else F.lit(None).cast("double")).alias("current_aqi"),
                F.col(observed).alias("observed_at_local"),
                forecast_time(F.col(observed)).alias("predicted_for_local"),
                F.lit(SCALE).alias("scale"),
                F.lit(SCALE_TEXT).alias("scale_description"),
            ).alias("realtime")
        )
    record.append(F.struct(F.lit(MODEL_VERSION).alias("model_version"), F.lit(HORIZON).alias("horizon_hours")).alias("meta"))
    record.append(advice_record(F.col("aqi_3h"), label, current, bucket, model_name if bucket is not None else None).alias("recommendations"))
    return scored.select(*(carried or []), *record)
