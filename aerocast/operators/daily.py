"""Distributions by day: histograms that add up over days, and the values behind them.

A day keeps, per feature, the number of readings and the least and greatest value of each logarithmic bucket (32
to an octave), and beside them every distinct value with its count, sorted. Buckets of any days add up, so
baselines, drift and percentiles of a window need no readings again: a bucket that lies between two edges counts as a
whole, and only for the few buckets that an edge cuts are values read. Results are equal to those over
the readings themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocast.contract import KS_LIMIT, PSI_LIMIT
from aerocast.operators import drift
from aerocast.operators.ordered import BUCKETS_PER_OCTAVE, long_form, order_bucket
from aerocast.session import scratch_path

BUCKETS = 32
_STEP = BUCKETS_PER_OCTAVE // BUCKETS
VALUES = "feature string, bucket bigint, value double, n bigint, day date"
HISTOGRAM = "feature string, bucket bigint, n bigint, lo double, hi double, day date"


def write_days(df: DataFrame, columns: list[str], root: str) -> None:
    """Store the distributions of the days that occur in ``df``; a day that is stored already is replaced.

    ``df`` must hold all readings of its days and is read once. Nulls and NaN are left out, as are rows without a time.
    """
    spark = df.sparkSession
    dated = df.filter("datetime IS NOT NULL").select(F.col("datetime").cast("date").alias("day"), *columns)
    # Copies of a value collapse before the shuffle, so a much repeated one is no large group.
    counted = long_form(dated, ["day"], columns).groupBy("day", "feature", "value").agg(F.count("*").alias("n"))
    bucket = F.floor(order_bucket(F.col("value")) / _STEP)
    values = counted.select("feature", bucket.alias("bucket"), "value", "n", "day")
    path = scratch_path(spark, "days", root)
    values.hint("rebalance", F.col("day")).sortWithinPartitions("day", "feature", "bucket", "value").write.parquet(path)
    values = spark.read.schema(VALUES).parquet(path)
    buckets = values.groupBy("feature", "bucket", "day").agg(
        F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    _replace_days(values, f"{root}/values")
    _replace_days(buckets.hint("rebalance", F.col("day")), f"{root}/histogram")


def _replace_days(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_histogram(spark: SparkSession, root: str, days: Column | None = None) -> DataFrame:
    """``feature, bucket, n, lo, hi`` over the chosen days."""
    stored = spark.read.schema(HISTOGRAM).parquet(f"{root}/histogram")
    chosen = stored if days is None else stored.filter(days)
    return chosen.groupBy("feature", "bucket").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def read_values(spark: SparkSession, root: str, wanted: list, days: Column | None = None) -> DataFrame:
    """``feature, value, n`` over the chosen days in the ``wanted`` (feature, bucket) pairs alone."""
    stored = spark.read.schema(VALUES).parquet(f"{root}/values")
    chosen = stored if days is None else stored.filter(days)
    inside = F.lit(False)
    for feature in sorted({f for f, _ in wanted}):
        # Compared with constants, so that files sorted by feature and bucket are skipped by their ranges.
        inside = inside | ((F.col("feature") == feature) & F.col("bucket").isin([b for f, b in wanted if f == feature]))
    return chosen.filter(inside).groupBy("feature", "bucket", "value").agg(F.sum("n").alias("n"))


def day_counts(spark: SparkSession, root: str, edges: DataFrame, days: Column | None = None) -> DataFrame:
    """``edges`` plus ``counts``, as ``drift.bin_counts`` over the readings of the chosen days."""
    known = edges.select("feature", "bins")
    buckets = read_histogram(spark, root, days).join(F.broadcast(known), "feature")

    def place(value: str) -> Column:
        """0 below the edges, the bin between them, one more than there are bins above."""
        above = F.when(F.col(value) > F.element_at("bins", -1), F.size("bins"))
        return F.coalesce(above, F.when(F.col(value) < F.element_at("bins", 1), 0), drift.bin_of(F.col(value), F.col("bins")))

    placed = buckets.withColumns({"bin": place("lo"), "_to": place("hi")})
    # Buckets do not overlap, so there are no more cut ones than edges.
    cut = [(r["feature"], r["bucket"]) for r in placed.filter("bin <> _to").select("feature", "bucket").collect()]
    counted = placed.filter("bin = _to").select("feature", "bin", "bins", "n")
    if cut:
        split = read_values(spark, root, cut, days).join(F.broadcast(known), "feature")
        counted = counted.unionByName(split.withColumn("bin", place("value")).select("feature", "bin", "bins", "n"))
    inside = counted.filter("bin > 0 AND bin < size(bins)").groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    return drift.with_counts(edges, inside)


def day_edges(spark: SparkSession, root: str, bins: int, days: Column | None = None) -> DataFrame:
    """Edges of equal width between the least and greatest value of the chosen days."""
    ends = read_histogram(spark, root, days).groupBy("feature").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))
    return drift.edges_between(ends, bins)


def day_baseline(spark: SparkSession, root: str, bins: int = 5, days: Column | None = None) -> DataFrame:
    """``drift.baseline_stats`` of the chosen days."""
    return drift.fractions_of(day_counts(spark, root, day_edges(spark, root, bins, days), days), "ref")


def day_drift(
    spark: SparkSession, root: str, baseline: DataFrame, days: Column, psi_limit: float = PSI_LIMIT, ks_limit: float = KS_LIMIT
) -> DataFrame:
    """``drift.drift_report`` of the chosen days against a baseline."""
    return drift.verdicts(drift.scores_of(day_counts(spark, root, baseline, days)), psi_limit, ks_limit)


def day_percentiles(spark: SparkSession, root: str, probs: dict[str, float], days: Column | None = None, exact: bool = True) -> DataFrame:
    """``feature, name, value, low, high``: percentiles of the chosen days, interpolated between neighbours.

    Without ``exact`` no values are read: ``value`` is the middle of the buckets that hold the wanted ranks, and the
    true percentile lies between ``low`` and ``high``, which are a 32nd of an octave apart (about two percent of the
    value) where both ranks lie in one bucket. With it the values of these buckets alone are read, and the three agree.
    """
    along = Window.partitionBy("feature").orderBy("bucket")
    whole = Window.partitionBy("feature")
    # A window over buckets: some thousands a feature at most, whatever the number of readings.
    before = F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = read_histogram(spark, root, days).withColumns({"_before": before, "_total": F.sum("n").over(whole)})
    names = spark.createDataFrame([(n, float(p)) for n, p in probs.items()], "name string, p double")
    # One row per percentile asked for.
    asked = ranked.join(F.broadcast(names)).withColumns(
        {"_r": F.col("p") * (F.col("_total") - 1), "_from": F.floor(F.col("p") * (F.col("_total") - 1)), "_to": F.ceil(F.col("p") * (F.col("_total") - 1))}
    )
    holds = asked.withColumns(
        {
            "_first": (F.col("_before") <= F.col("_from")) & (F.col("_from") < F.col("_before") + F.col("n")),
            "_second": (F.col("_before") <= F.col("_to")) & (F.col("_to") < F.col("_before") + F.col("n")),
        }
    ).filter("_first OR _second")
    if not exact:
        span = holds.groupBy("feature", "name").agg(F.min("lo").alias("low"), F.max("hi").alias("high"))
        return span.select("feature", "name", ((F.col("low") + F.col("high")) / 2).alias("value"), "low", "high")
    # Two buckets at most for a feature and percentile.
    wanted = [tuple(r) for r in holds.select("feature", "bucket").distinct().collect()]
    inside = Window.partitionBy("feature", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    values = read_values(spark, root, wanted, days).withColumn("_below", F.coalesce(F.sum("n").over(inside), F.lit(0))).withColumnRenamed("n", "_n")
    placed = holds.drop("lo", "hi", "n").join(values, ["feature", "bucket"])
    at = F.col("_before") + F.col("_below")

    def of(rank: str) -> Column:
        return F.max(F.when((at <= F.col(rank)) & (F.col(rank) < at + F.col("_n")), F.col("value")))

    found = placed.groupBy("feature", "name").agg(of("_from").alias("a"), of("_to").alias("b"), F.max(F.col("_r") - F.col("_from")).alias("share"))
    value = F.col("a") + (F.col("b") - F.col("a")) * F.col("share")
    return found.select("feature", "name", value.alias("value"), value.alias("low"), value.alias("high"))
