"""Profiles of the readings: counts, gaps, spread, correlation, histograms."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocast.operators.ordered import percentiles, percentiles_of, value_totals
from aerocast.session import materialise

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
WHISKER = 1.5
# Hours of a stretch of the grid that is worked on as one row.
BLOCK_HOURS = 720
HOUR_MICROS = 3_600_000_000


def wide_to_rows(one_row: DataFrame, columns: list[str], parts: list[str], name: str = "column") -> DataFrame:
    """Turn the single row of ``{part}|{column}`` aggregates into one row per column."""
    cells = [
        F.struct(F.lit(c).alias(name), *[F.col(f"`{p}|{c}`").alias(p) for p in parts]) for c in columns
    ]
    return one_row.select(F.inline(F.array(*cells)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """Share of each value, overall or within each key."""
    keys = keys or []
    counted = df.groupBy(*keys, column).agg(F.count("*").alias("n"))
    # Totals over the already counted values, never over raw rows.
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("_all"))
    joined = counted.join(totals, keys) if keys else counted.withColumn("_all", totals.scalar())
    return joined.select(*keys, column, "n", (F.col("n") / F.col("_all")).alias("share"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share per column, in one pass, most nulls first."""
    aggs = []
    for c in df.columns:
        missing = F.col(c).isNull().cast("int")
        aggs += [F.sum(missing).alias(f"n_null|{c}"), F.avg(missing).alias(f"null_share|{c}")]
    return wide_to_rows(df.agg(*aggs), df.columns, ["n_null", "null_share"]).orderBy(F.desc("n_null"), "column")


def duplicate_counts(df: DataFrame, keys=("city", "datetime")) -> DataFrame:
    """Surplus rows: copies of a whole row, and further rows of a key.

    One pass: rows are counted as wholes, then these counts by key. Wholes are told apart by 128 bits of hashes, so
    the shuffle carries the key and two numbers. Hashes pass over nulls, so their places are hashed as well,
    and 0.0 is added to make zeros of either sign equal.
    """
    parts = [F.col(c) + F.lit(0.0) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes]
    nulls = F.concat(*[F.when(F.col(c).isNull(), "n").otherwise("v") for c in df.columns])
    hashes = (F.xxhash64(nulls, *parts).alias("_h1"), F.xxhash64(F.lit("second"), nulls, *parts).alias("_h2"))
    whole = df.groupBy(*keys, *hashes).agg(F.count("*").alias("n"))
    by_key = whole.groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("copies"), F.sum("n").alias("n"))
    one = by_key.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("a"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("b"))
    scopes = [F.struct(F.lit(s).alias("scope"), F.col(c).alias("duplicates")) for s, c in (("row", "a"), ("key", "b"))]
    return one.select(F.inline(F.array(*scopes)))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per column.

    The columns are stored once, as counting buckets, reading the wanted ones and the moments take three passes.
    """
    df, aggs = materialise(df.select(*columns), "described"), []
    for c in columns:
        aggs += [
            F.count(c).alias(f"count|{c}"),
            F.avg(c).alias(f"mean|{c}"),
            F.stddev_samp(c).alias(f"std|{c}"),
            F.min(c).alias(f"min|{c}"),
            F.max(c).alias(f"max|{c}"),
        ]
    basic = wide_to_rows(df.agg(*aggs), columns, ["count", "mean", "std", "min", "max"], "feature")
    spread = percentiles(df, columns, QUARTILES)
    return basic.join(spread, "feature", "left").select("feature", "count", "mean", "std", "min", *QUARTILES, "max")


def box_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per city and column: quartiles, 1.5-IQR whiskers and the number of outliers.

    Rows without a city are left out. Values are counted once and stored: the counts are read for
    the quartiles and for the whiskers, and a city with many values can be split in the join.
    """
    keys = ["city", "feature"]
    counted = materialise(value_totals(df.filter(F.col("city").isNotNull()), ["city"], columns), "value-counts")
    box = percentiles_of(counted, keys, QUARTILES)
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    spread = (
        counted.join(box, keys)
        .groupBy(*keys)
        .agg(
            *[F.max(q).alias(q) for q in QUARTILES],
            F.min(F.when(inside, F.col("value"))).alias("_lo"),
            F.max(F.when(inside, F.col("value"))).alias("_hi"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("n_outliers"),
        )
    )
    return spread.select(
        *keys,
        *QUARTILES,
        F.least("_lo", "q1").alias("whisker_low"),
        F.greatest("_hi", "q3").alias("whisker_high"),
        "n_outliers",
    )


def _months(span: DataFrame) -> DataFrame:
    """The months between ``_a`` and ``_b``, one row each, with the part of the span inside them.

    A span is opened in two steps, so that no array is longer than the months of the calendar.
    """
    first = F.explode(F.sequence(F.trunc("_a", "month"), F.trunc("_b", "month"), F.expr("INTERVAL 1 MONTH")))
    return span.withColumn("_month", first)


def daily_mean(df: DataFrame, columns: list[str], key: str = "city") -> DataFrame:
    """Daily means per series over every day between its first and last reading.

    Days without readings appear with null means.
    """
    day = F.col("datetime").cast("date")
    means = df.groupBy(key, day.alias("day")).agg(*[F.avg(c).alias(f"{c}_mean") for c in columns])
    span = means.groupBy(key).agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
    inside = F.sequence(F.greatest("_a", "_month"), F.least("_b", F.last_day("_month")), F.expr("INTERVAL 1 DAY"))
    days = _months(span).select(key, F.explode(inside).alias("day"))
    return days.join(means, [key, "day"], "left")


def missing_ranges(df: DataFrame) -> DataFrame:
    """Gaps between a city's readings: ``city, gap_start, gap_end, hours``, the first and last missing stamp of each.

    Stamps are hourly from the first reading on and keep its minutes and seconds; readings off this grid fill nothing.
    The hours held are gathered per 30 days, which combines before the shuffle, and gaps are read off between
    neighbours, the last hour of the block before included; the grid itself is never built.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("datetime"))
    offset = F.pmod(micros, F.lit(HOUR_MICROS))
    hour = ((micros - offset) / HOUR_MICROS).cast("bigint")
    held = df.filter("city IS NOT NULL AND datetime IS NOT NULL").select(
        "city", "datetime", micros.alias("_micros"), offset.alias("_offset"), hour.alias("_hour"), F.floor(hour / BLOCK_HOURS).alias("_block")
    )
    blocks = held.groupBy("city", "_offset", "_block").agg(
        F.sort_array(F.collect_set("_hour")).alias("_hours"), F.min("datetime").alias("_first"), F.max("_micros").alias("_latest")
    )
    # One row per block from here on. The city's first reading sets the offset of the grid, its last one the end.
    city, along = Window.partitionBy("city"), Window.partitionBy("city", "_offset").orderBy("_block")
    placed = blocks.withColumns(
        {
            "_start": F.min(F.struct("_first", "_offset")).over(city)["_offset"],
            "_end": F.max("_latest").over(city),
            "_before": F.array(F.lag(F.element_at("_hours", -1)).over(along)),
            "_last": F.lead("_block").over(along).isNull(),
        }
    ).filter("_offset = _start")
    after = F.when(F.col("_last"), F.floor((F.col("_end") - F.col("_start")) / HOUR_MICROS) + 1)
    chain = placed.withColumn("_chain", F.array_compact(F.concat("_before", "_hours", F.array(after))))
    gaps = "filter(transform(_chain, (h, i) -> struct(get(_chain, i - 1) + 1 AS a, h - 1 AS b)), g -> g.a <= g.b)"
    found = chain.select("city", "_first", F.element_at("_hours", 1).alias("_hour"), F.inline(F.expr(gaps)))

    def stamp(h: str) -> Column:
        return F.timestamp_add("HOUR", (F.col(h) - F.col("_hour")).cast("int"), F.col("_first"))

    return found.select("city", stamp("a").alias("gap_start"), stamp("b").alias("gap_end"), (F.col("b") - F.col("a") + 1).alias("hours"))


def missing_stamps(df: DataFrame) -> DataFrame:
    """Hourly stamps between a city's first and last reading that have no reading (see ``missing_ranges``)."""
    # Long gaps are opened by 30 days first, so no array is longer than the gaps or a block.
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("hours") - 1) / BLOCK_HOURS)))
    parts = missing_ranges(df).select("city", "gap_start", "hours", part.alias("_part"))
    inside = F.sequence(F.col("_part") * BLOCK_HOURS, F.least(F.col("hours") - 1, F.col("_part") * BLOCK_HOURS + BLOCK_HOURS - 1))
    hours = parts.select("city", "gap_start", F.explode(inside).alias("_offset"))
    return hours.select("city", F.timestamp_add("HOUR", F.col("_offset").cast("int"), F.col("gap_start")).alias("datetime"))


def missing_hours(df: DataFrame) -> DataFrame:
    """Number of missing hourly stamps per city, zero included.

    Counts by arithmetic instead of building the grid. Stamps are grouped by their offset
    within the hour; only those with the offset of the first reading lie on the grid.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("datetime"))
    by_offset = (
        df.select("city", "datetime")
        .distinct()
        .groupBy("city", F.pmod(micros, F.lit(3_600_000_000)).alias("_offset"))
        .agg(F.count("*").alias("n"), F.min("datetime").alias("_a"), F.max("datetime").alias("_b"))
    )
    per_city = by_offset.groupBy("city").agg(
        F.min_by("n", "_a").alias("_held"), F.min("_a").alias("_a"), F.max("_b").alias("_b")
    )
    expected = F.timestamp_diff("HOUR", F.col("_a"), F.col("_b")) + 1
    return per_city.select("city", (expected - F.col("_held")).alias("missing_hours"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all pairs in one aggregation.

    The number of pairs depends on the schema, not on the data. Pairs with a null are skipped.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        value = F.col(f"`{a}|{b}`").alias("corr")
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), value))
    return one.select(F.inline(F.array(*cells)))


def single_valued_columns(df: DataFrame) -> DataFrame:
    """Columns that hold at most one distinct value (null counts as a value)."""
    aggs = []
    for c in df.columns:
        alone = F.min(c).eqNullSafe(F.max(c)) & ((F.count(c) == 0) | (F.count(c) == F.count("*")))
        aggs.append(alone.alias(f"single|{c}"))
    return wide_to_rows(df.agg(*aggs), df.columns, ["single"]).filter("single").select("column")


def conflicting_labels(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Number of rows whose features also occur with another label."""
    groups = df.groupBy(*features).agg(F.min(label).alias("_a"), F.max(label).alias("_b"), F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.when(F.col("_a") != F.col("_b"), F.col("n"))), F.lit(0)).alias("n_conflicts"))


def split_periods(df: DataFrame) -> DataFrame:
    """First and last time and row count per split."""
    return df.groupBy("split").agg(
        F.min("datetime").alias("start"), F.max("datetime").alias("end"), F.count("*").alias("n")
    )

