"""Calendar parts, time parsing and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocast.contract import HORIZON

# --- Fixed values: accepted spellings of a local time, ISO first, then day before month. ---
TIME_FORMATS = [
    "yyyy-M-d'T'H:m[:s]",
    "yyyy-M-d[ H:m[:s]]",
    "d/M/yyyy[ H:m[:s]]",
    "d-M-yyyy[ H:m[:s]]",
    "d.M.yyyy[ H:m[:s]]",
]
# Trailing zone offset or Z, and fractions of a second, both dropped before parsing.
ZONE_SUFFIX = r"\s*(Z|[+-]\d{2}:?\d{2})$"
FRACTION = r"(:\d{1,2})\.\d+$"
LOCAL_OFFSET_HOURS = 5


def calendar_columns(ts: Column) -> dict[str, Column]:
    """hour, dayofweek (Monday = 0), month and is_weekend of a local time."""
    dow = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "dayofweek": dow,
        "month": F.month(ts),
        "is_weekend": (dow >= 5).cast("int"),
    }


def parse_local_time(text: Column) -> Column:
    """Wall-clock time of a text in ISO or day-first form; null if it fits neither.

    A zone offset is dropped, not applied: the wall clock is what the readings are keyed on.
    """
    bare = F.regexp_replace(F.trim(text), ZONE_SUFFIX, "")
    bare = F.regexp_replace(bare, FRACTION, "$1")
    tries = [F.try_to_timestamp(bare, F.lit(f)).cast("timestamp_ntz") for f in TIME_FORMATS]
    return F.coalesce(*tries)


def as_local_time(column: Column, dtype: str) -> Column:
    """Bring a datetime column of any stored type to a zone-free timestamp."""
    if dtype == "timestamp_ntz":
        return column
    if dtype in ("timestamp", "date"):
        return column.cast("timestamp_ntz")
    return parse_local_time(column.cast("string"))


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds as a zone-free UTC time."""
    return F.timestamp_add("SECOND", seconds.cast("bigint"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_to_local(seconds: Column) -> Column:
    """Epoch seconds as the wall clock at the fixed station offset."""
    return F.timestamp_add("HOUR", F.lit(LOCAL_OFFSET_HOURS), epoch_to_utc(seconds))


def forecast_time(observed: Column, horizon: int = HORIZON) -> Column:
    return F.timestamp_add("HOUR", F.lit(horizon), observed)


def display_time(ts: Column) -> Column:
    """``05 Jan 2024, 03:00 PM PKT``."""
    return F.concat(F.date_format(ts, "dd MMM yyyy, hh:mm a"), F.lit(" PKT"))
