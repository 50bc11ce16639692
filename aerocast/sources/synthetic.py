"""Seeded synthetic readings for trial runs without data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.contract import MEASURES, SEED

# Daily swing around a middle: (middle, swing, noise) of the measures that are not rules below.
SWINGS = {
    "components_co": (420.0, 160.0, 60.0),
    "components_no": (6.0, 4.0, 1.5),
    "components_no2": (24.0, 9.0, 4.0),
    "components_o3": (58.0, 31.0, 6.0),
    "components_so2": (8.0, 2.5, 1.2),
    "components_nh3": (5.0, 1.6, 0.8),
    "temperature_2m": (21.0, 8.0, 2.0),
    "relative_humidity_2m": (52.0, 18.0, 5.0),
    "dew_point_2m": (10.0, 3.0, 1.5),
    "surface_pressure": (1004.0, 3.0, 1.0),
    "wind_speed_10m": (9.0, 4.0, 2.0),
    "wind_direction_10m": (185.0, 120.0, 30.0),
}
# Days over which the level rises from its lowest to its highest value.
RISE_DAYS = 5
FIRST_HOUR = "2024-01-01 00:00:00"


def _noise(city: Column, hour: Column, name: str) -> Column:
    """A number in [-1, 1) that depends on the seed, the city, the hour and the measure alone."""
    return F.pmod(F.xxhash64(F.lit(SEED), F.lit(name), city, hour), F.lit(20_000)) / 10_000.0 - 1.0


def synthetic_readings(spark: SparkSession, rows: int = 600, cities=("Islamabad", "Lahore", "Karachi")) -> DataFrame:
    """``rows`` hourly readings spread evenly over the cities, the same for any partitioning."""
    per_city = rows // len(cities)
    ids = spark.range(per_city * len(cities))
    hour = F.col("id") % per_city
    city = F.element_at(F.array(*[F.lit(c) for c in cities]), (F.floor(F.col("id") / per_city) + 1).cast("int"))
    based = ids.select(city.alias("city"), hour.alias("_hour"))
    city, hour = F.col("city"), F.col("_hour")
    wave = F.sin(hour * (2 * 3.141592653589793 / 24))
    rise = 1.4 + 3.4 * F.least(F.lit(1.0), hour / (24.0 * RISE_DAYS))
    level = F.greatest(F.lit(1.0), F.least(F.lit(5.0), rise + 0.5 * _noise(city, hour, "main_aqi")))
    made = {"main_aqi": level}
    made |= {c: middle + swing * wave + noise * _noise(city, hour, c) for c, (middle, swing, noise) in SWINGS.items()}
    # Fine dust follows the level, rain falls in a tenth of the hours, the sun shines by day.
    made["components_pm2_5"] = level * 14 + 3 * _noise(city, hour, "pm2_5")
    made["components_pm10"] = level * 22 + 6 * _noise(city, hour, "pm10")
    made["precipitation"] = F.greatest(F.lit(0.0), 5 * _noise(city, hour, "rain") - 4)
    made["shortwave_radiation"] = F.greatest(F.lit(0.0), 620 * wave)
    at = F.timestamp_add("HOUR", hour.cast("int"), F.lit(FIRST_HOUR).cast("timestamp_ntz"))
    return based.select("city", at.alias("datetime"), *[made[c].alias(c) for c in MEASURES])
