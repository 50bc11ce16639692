"""Cleaning, conforming and deduplicating raw readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.contract import BUILD_CUTOFF, CITIES, ContractError, missing_columns, require_columns
from aerocast.functions.calendar import as_local_time

# Column that landing adds: the place of a row in its source, files in the order of their names.
ROW_ORDER = "row_order"
# Rows without a place come after all that have one.
UNORDERED = 2**62


def standard_headers(df: DataFrame) -> DataFrame:
    """Trim column names and turn dots into underscores."""
    return df.toDF(*[c.strip().replace(".", "_") for c in df.columns])


def parse_datetime(df: DataFrame) -> DataFrame:
    """Bring ``datetime`` to a zone-free timestamp and drop rows that have none."""
    dtype = dict(df.dtypes)["datetime"]
    return df.withColumn("datetime", as_local_time(F.col("datetime"), dtype)).filter(F.col("datetime").isNotNull())


def numeric_measures(df: DataFrame, keep=("city", "datetime")) -> DataFrame:
    """Cast every non-key column to double; unparsable text and NaN become null."""

    def to_number(name: str, dtype: str) -> Column:
        value = F.col(name).try_cast("double") if dtype == "string" else F.col(name).cast("double")
        return F.when(~F.isnan(value), value).alias(name)

    return df.select(*[F.col(n) if n in keep else to_number(n, t) for n, t in df.dtypes])


def city_key(city: Column) -> Column:
    """Lookup form of a city name."""
    return F.lower(F.trim(city))


def city_name(city: Column) -> Column:
    """Model form of a city name; training and serving both use it."""
    return F.initcap(F.trim(city))


def with_city(df: DataFrame) -> DataFrame:
    """Cast the city to text and reject rows without one."""
    return df.withColumn("city", F.col("city").cast("string")).filter(F.col("city").isNotNull())


def before_cutoff(df: DataFrame, cutoff: str = BUILD_CUTOFF) -> DataFrame:
    """Rows up to and including the cutoff."""
    return df.filter(F.col("datetime") <= F.lit(cutoff).cast("timestamp_ntz"))


def align_columns(df: DataFrame, expected: list[str], label: str = "input") -> DataFrame:
    """Exactly the expected columns plus the city: error on a gap, extras dropped, order fixed."""
    missing = missing_columns(df, expected)
    if missing:
        raise ContractError(f"{label} lacks columns {missing}")
    return df.select(*[c for c in expected if c != "city"], "city")


def first_per_key(df: DataFrame, keys=("city", "datetime"), order: str = ROW_ORDER) -> DataFrame:
    """One row per key: the one with the smallest ``order`` value, which is dropped.

    An aggregation on hashes, not a window: copies collapse on the map side, so a key that holds
    a large share of all rows never meets in one task. ``order`` is a unique integer column of
    the source order. Rows without one come last, in the order of a hash of the whole row.
    """
    require_columns(df, [*keys, order])
    rest = [c for c in df.columns if c not in keys and c != order]
    unordered = F.lit(UNORDERED) + F.pmod(F.xxhash64(*df.columns), F.lit(UNORDERED))
    ranked = df.withColumn("_rank", F.coalesce(F.col(order).cast("bigint"), unordered))
    # min_by keeps its row as one buffer per column; fixed-width columns stay in a hash aggregate.
    return ranked.groupBy(*keys).agg(*[F.min_by(F.col(c), F.col("_rank")).alias(c) for c in rest])


def clean_readings(df: DataFrame, order: str = ROW_ORDER) -> DataFrame:
    """Raw rows to unique readings: typed, dated, with a city in model form, one row per key."""
    named = with_city(parse_datetime(standard_headers(df)))
    typed = numeric_measures(named.withColumn("city", city_name(F.col("city"))), ("city", "datetime", order))
    return first_per_key(typed, order=order)


def supported_cities(df: DataFrame) -> DataFrame:
    """Rows of the five supported cities, matched on the lookup form."""
    return df.filter(city_key(F.col("city")).isin([c for c, _, _ in CITIES]))


def unsupported_cities(df: DataFrame) -> DataFrame:
    """The rejected rows: unknown or missing city."""
    return df.filter(~F.coalesce(city_key(F.col("city")).isin([c for c, _, _ in CITIES]), F.lit(False)))


def city_dimension(spark) -> DataFrame:
    """The fixed five-row city table."""
    return spark.createDataFrame(CITIES, "city_key string, lat double, lon double")


def with_coordinates(df: DataFrame) -> DataFrame:
    """Attach coordinates by city; the dimension is a fixed five rows, so it is broadcast."""
    cities = F.broadcast(city_dimension(df.sparkSession))
    return df.withColumn("city_key", city_key(F.col("city"))).join(cities, "city_key", "left")


def coalesce_pollutants(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing pollutant concentrations count as 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


def trailing_days(df: DataFrame, days: int = 7) -> DataFrame:
    """Rows of each city within ``days`` before its last reading (strict lower bound)."""
    last = df.groupBy("city").agg(F.max("datetime").alias("_last"))
    # One row per city against all readings: a plain join lets the optimizer broadcast the
    # small side by its measured size, or shuffle with skew splitting beyond that.
    kept = df.join(last, "city").filter(F.col("datetime") > F.col("_last") - F.expr(f"INTERVAL {days} DAYS"))
    return kept.drop("_last")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, keeping duplicates."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def latest_per_city(df: DataFrame) -> DataFrame:
    """The newest row of every city."""
    rest = [c for c in df.columns if c != "city"]
    return df.groupBy("city").agg(*[F.max_by(F.col(c), F.col("datetime")).alias(c) for c in rest])


def join_observations(pollutants: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per city with its newest pollutant and its newest weather observation."""
    left = latest_per_city(pollutants).withColumnRenamed("datetime", "observed_at")
    right = latest_per_city(weather).withColumnRenamed("datetime", "weather_at")
    return left.join(right, "city")
