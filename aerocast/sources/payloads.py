"""Landed JSON payloads of the pollutant and weather services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.contract import POLLUTANTS, WEATHER
from aerocast.functions.calendar import epoch_to_local, epoch_to_utc, parse_local_time

_COMPONENTS = ", ".join(f"{p}: double" for p in POLLUTANTS)
POLLUTANT_JSON = f"list array<struct<main: struct<aqi: double>, components: struct<{_COMPONENTS}>, dt: bigint>>"
_SERIES = ", ".join(f"{c}: array<double>" for c in WEATHER)
WEATHER_JSON = f"hourly struct<time: array<string>, {_SERIES}>"


def pollutant_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """First list entry of each pollutant payload as flat columns; other columns are kept.

    A payload without an entry gives nulls. Times are the wall clock in UTC and at the
    station offset.
    """
    entry = F.get(F.from_json(F.col(payload), POLLUTANT_JSON)["list"], F.lit(0))
    rest = [c for c in df.columns if c != payload]
    opened = df.select(*rest, entry.alias("_e"))
    return opened.select(
        *rest,
        F.col("_e.main.aqi").alias("main_aqi"),
        *[F.col(f"_e.components.{p}").alias(f"components_{p}") for p in POLLUTANTS],
        epoch_to_utc(F.col("_e.dt")).alias("observed_at_utc"),
        epoch_to_local(F.col("_e.dt")).alias("observed_at_local"),
    )


def _weather(df: DataFrame, payload: str) -> tuple[list[str], DataFrame]:
    rest = [c for c in df.columns if c != payload]
    return rest, df.select(*rest, F.from_json(F.col(payload), WEATHER_JSON)["hourly"].alias("_h"))


def weather_last(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Last hour of each column-oriented weather payload."""

    def last(series: Column) -> Column:
        return F.when(F.size(series) > 0, F.try_element_at(series, F.lit(-1)))

    rest, opened = _weather(df, payload)
    return opened.select(
        *rest,
        parse_local_time(last(F.col("_h.time"))).alias("datetime"),
        *[last(F.col(f"_h.{c}")).alias(c) for c in WEATHER],
    )


def weather_hours(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Every hour of each weather payload as a row."""
    rest, opened = _weather(df, payload)
    # By position in the time array; a series the payload lacks, or a shorter one, gives nulls.
    hours = opened.select(*rest, "_h", F.posexplode("_h.time").alias("_i", "_time"))
    return hours.select(
        *rest, parse_local_time(F.col("_time")).alias("datetime"), *[F.get(f"_h.{c}", F.col("_i")).alias(c) for c in WEATHER]
    )
