"""Exact order statistics without sorting a whole group in one task.

Percentiles, rank-based scores and seeded samples all need to know how much of a group lies
below a value. A window over the group would bring a hot group into one task. Here the
distinct values are counted first (copies collapse on the map side), then split into ordered
buckets: totals per bucket are few and are summed in order per group, and the exact order is
only worked out inside single buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.session import materialise

BUCKETS_PER_OCTAVE = 4096
_EXPONENT_SPAN = 1100.0


def order_bucket(value: Column) -> Column:
    """Integer that never decreases as a finite double grows.

    Buckets are logarithmic: 4096 per doubling of the magnitude, so they adapt to any scale
    without a pass over the data, and an outlier cannot squeeze the rest into one bucket.
    """
    size = F.greatest(F.least(F.log2(F.abs(value)), F.lit(_EXPONENT_SPAN)), F.lit(-_EXPONENT_SPAN))
    rank = F.floor((size + _EXPONENT_SPAN) * BUCKETS_PER_OCTAVE) + 1
    return F.when(value > 0, rank).when(value < 0, -rank).otherwise(F.lit(0).cast("bigint"))


def long_form(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, feature, value) with one row per non-null value."""
    numeric = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    tall = numeric.unpivot(keys, columns, "feature", "value")
    return tall.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def value_totals(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, feature, value, n): how often each value occurs."""
    return long_form(df, keys, columns).groupBy(*keys, "feature", "value").agg(F.count("*").alias("n"))


def bucket_offsets(bucketed: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    """Per (keys, _bucket): amount before the bucket, inside it, and in the whole group.

    Without keys the totals are put in order in one task: at most one row per bucket, which is
    bounded by the buckets of the doubles (or hours) that occur, not by the rows.
    """
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(*[F.expr(f"sum({a}) AS _in_{a}") for a in amounts])
    # One row per bucket, not per value, so this window stays small even for a hot group.
    group = f"PARTITION BY {', '.join(keys)}" if keys else ""
    before = f"({group} ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return per_bucket.selectExpr(
        "*",
        *[f"coalesce(sum(_in_{a}) OVER {before}, 0) AS _before_{a}" for a in amounts],
        *[f"sum(_in_{a}) OVER ({group}) AS _total_{a}" for a in amounts],
    )


def running_totals(
    df: DataFrame, keys: list[str], value: str, amounts: list[str], bucket: Column | None = None, keep: str | None = None
) -> DataFrame:
    """Add ``{amount}_below`` (amount at smaller values of the group) and ``{amount}_total``.

    One row per (keys, value) is expected. ``bucket`` must not decrease as ``value`` grows.
    ``keep`` is an optional filter on bucket level over the ``_before_``, ``_in_`` and
    ``_total_`` columns, applied before any row is ordered.
    """
    bucketed = df.withColumn("_bucket", order_bucket(F.col(value)) if bucket is None else bucket)
    offsets = bucket_offsets(bucketed, keys, amounts)
    if keep is not None:
        offsets = offsets.filter(keep)
    placed = bucketed.join(offsets.hint("shuffle_hash"), [*keys, "_bucket"])
    by = ", ".join([*keys, "_bucket"])
    inside = f"(PARTITION BY {by} ORDER BY `{value}` ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return placed.selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"_before_{a} + coalesce(sum({a}) OVER {inside}, 0) AS {a}_below" for a in amounts],
        *[f"_total_{a} AS {a}_total" for a in amounts],
    )


def _ranks(p: float, n: str) -> dict[str, str]:
    """The two 0-based ranks between which a percentile lies."""
    return {"lo": f"floor({p}D * ({n} - 1))", "hi": f"ceil({p}D * ({n} - 1))"}


def _holds_rank(probs: dict[str, float]) -> str:
    """Condition for a bucket that holds a rank of any of the percentiles."""
    wanted = [r for p in probs.values() for r in _ranks(p, "_total_n").values()]
    return " OR ".join(f"(_before_n <= {r} AND {r} < _before_n + _in_n)" for r in wanted)


def _read_percentiles(placed: DataFrame, keys: list[str], probs: dict[str, float], value: str) -> DataFrame:
    """Percentiles from counted values with the number of rows below them."""
    found = placed.groupBy(*keys).agg(
        F.expr("max(n_total) AS _n"),
        *[
            F.expr(f"max(CASE WHEN n_below <= {r} AND {r} < n_below + n THEN `{value}` END) AS _{side}_{name}")
            for name, p in probs.items()
            for side, r in _ranks(p, "n_total").items()
        ],
    )
    return found.selectExpr(
        *keys,
        *[
            f"_lo_{name} + (_hi_{name} - _lo_{name}) * ({p}D * (_n - 1) - floor({p}D * (_n - 1))) AS {name}"
            for name, p in probs.items()
        ],
    )


def percentiles_of(
    totals: DataFrame, keys: list[str], probs: dict[str, float], value: str = "value", bucket: Column | None = None
) -> DataFrame:
    """Exact, linearly interpolated percentiles of counted values (keys, value, n)."""
    placed = running_totals(totals, keys, value, ["n"], bucket, _holds_rank(probs))
    return _read_percentiles(placed, keys, probs, value)


def percentiles(df: DataFrame, columns: list[str], probs: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """Exact percentiles of several columns, one row per (keys, feature)."""
    if keys:
        return percentiles_of(value_totals(df, keys, columns), [*keys, "feature"], probs)
    # Over whole columns only a few buckets are of interest. Buckets are counted first, and a
    # second pass shuffles the values of those buckets alone. The list of wanted buckets has
    # at most two rows per column and percentile, so it is broadcast.
    tall = long_form(df, [], columns).withColumn("_bucket", order_bucket(F.col("value")))
    offsets = bucket_offsets(tall.withColumn("n", F.lit(1)), ["feature"], ["n"]).filter(_holds_rank(probs))
    near = tall.join(F.broadcast(offsets), ["feature", "_bucket"])
    carried = ["_before_n", "_total_n"]
    counted = near.groupBy("feature", "_bucket", "value", *carried).agg(F.count("*").alias("n"))
    inside = "(PARTITION BY feature, _bucket ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = counted.selectExpr(
        "feature", "value", "n", f"_before_n + coalesce(sum(n) OVER {inside}, 0) AS n_below", "_total_n AS n_total"
    )
    return _read_percentiles(placed, ["feature"], probs, "value")


def time_percentile(df: DataFrame, prob: float) -> DataFrame:
    """One row ``cutoff_us``: percentile of ``datetime`` in epoch microseconds."""
    counted = df.groupBy("datetime").agg(F.count("*").alias("n"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("datetime"))
    timed = counted.select(micros.cast("double").alias("value"), "n", F.floor(micros / 3_600_000_000).alias("_hour"))
    return percentiles_of(timed, [], {"cutoff_us": prob}, bucket=F.col("_hour"))


def area_under_curve(scored: DataFrame, label: str, score: str, keys: list[str] | None = None) -> DataFrame:
    """ROC-AUC by exact rank sums, ties counted half; null if only one class is present.

    Scores are counted once and stored, as the rank sums read the counts twice.
    """
    keys = keys or []
    counted = (
        scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("_score"))
        .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg"))
    )
    placed = running_totals(materialise(counted, "score-counts"), keys, "_score", ["pos", "neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total").cast("double")
    return placed.groupBy(*keys).agg(F.when(pairs > 0, wins / pairs).alias("roc_auc"))
