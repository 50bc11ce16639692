"""Column contract, thresholds and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = ("city", "datetime")

# --- Fixed values: measured columns, in contract order. ---
MEASURES = [
    "main_aqi",
    "components_co",
    "components_no",
    "components_no2",
    "components_o3",
    "components_so2",
    "components_pm2_5",
    "components_pm10",
    "components_nh3",
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "precipitation",
    "surface_pressure",
    "wind_speed_10m",
    "wind_direction_10m",
    "shortwave_radiation",
]
POLLUTANTS = ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]
WEATHER = MEASURES[9:]

CALENDAR = ["hour", "dayofweek", "month", "is_weekend"]
LAGGED = ["main_aqi", "components_pm2_5", "components_pm10"]
ROLLED = ["components_pm2_5", "components_pm10"]
LAG_STEPS = 3
ROLL_ROWS = 3
HORIZON = 3

TARGET = "main_aqi_t_plus_h"
HAZARD = "hazard_t_plus_h"

LAG_COLUMNS = [f"{c}_lag_{k}" for c in LAGGED for k in range(1, LAG_STEPS + 1)]
ROLL_COLUMNS = [f"{c}_roll{ROLL_ROWS}_mean" for c in ROLLED]
ENGINEERED = LAG_COLUMNS + ROLL_COLUMNS

# The 33 model inputs in serving order.
FEATURES = MEASURES + ["city"] + CALENDAR + LAG_COLUMNS + ROLL_COLUMNS

# --- Fixed values: columns every raw reading must carry, and the valid level range. ---
REQUIRED_RAW = ["city", "datetime", "main_aqi", "components_pm2_5", "components_pm10"]
AQI_LOW, AQI_HIGH = 1.0, 5.0
HAZARD_FROM = 4.0

# --- Fixed values: time cut-offs of the published data sets. ---
TRAIN_CUTOFF = "2023-12-31 23:59:59"
BUILD_CUTOFF = "2024-06-30 23:00:00"

# --- Fixed values: drift limits. ---
PSI_EPSILON = 1e-6
PSI_LIMIT = 0.3
KS_LIMIT = 0.5

# --- Fixed values: supported cities and their coordinates. ---
CITIES = [
    ("islamabad", 33.6844, 73.0479),
    ("lahore", 31.5204, 74.3587),
    ("karachi", 24.8607, 67.0011),
    ("peshawar", 34.0151, 71.5249),
    ("quetta", 30.1798, 66.9750),
]

MODEL_VERSION = "0.1.0"
SEED = 42


class ContractError(ValueError):
    """Input does not meet the column contract or a data rule."""


def readings_schema() -> T.StructType:
    """Schema of the unified hourly readings table."""
    return T.StructType(
        [T.StructField("city", T.StringType()), T.StructField("datetime", T.TimestampNTZType())]
        + [T.StructField(c, T.DoubleType()) for c in MEASURES]
    )


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required names that ``df`` lacks, in the order they are required."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required, what: str = "input") -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"{what} lacks required columns: {missing}")


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs of a training frame: every column but the time and the targets."""
    return [c for c in df.columns if c not in ("datetime", TARGET, HAZARD)]
