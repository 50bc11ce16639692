"""Histograms and distribution drift against a stored baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.contract import KS_LIMIT, PSI_EPSILON, PSI_LIMIT, ContractError, missing_columns
from aerocast.operators.ordered import long_form
from aerocast.operators.profile import wide_to_rows


class DriftDetected(ContractError):
    """A feature moved too far from its baseline."""


def numeric_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns that exist and hold numbers."""
    kinds = dict(df.dtypes)
    plain = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c in columns if kinds.get(c) in plain or kinds.get(c, "").startswith("decimal")]


def equal_width_edges(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """(feature, bins): n + 1 edges from minimum to maximum; empty columns are left out.

    A constant column gets a range of one unit around its value.
    """
    aggs = []
    for c in columns:
        number = F.col(c).cast("double")
        known = F.when(~F.isnan(number), number)
        aggs += [F.min(known).alias(f"_lo|{c}"), F.max(known).alias(f"_hi|{c}")]
    return edges_between(wide_to_rows(df.agg(*aggs), columns, ["_lo", "_hi"], "feature"), bins)


def edges_between(ends: DataFrame, bins: int) -> DataFrame:
    """(feature, bins) from (feature, _lo, _hi); see ``equal_width_edges``."""
    ends = ends.filter(F.col("_lo").isNotNull())
    flat = F.col("_lo") == F.col("_hi")
    lo = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    hi = F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(bins)
    inner = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: i * F.col("step") + F.col("lo"))
    return (
        ends.select("feature", lo.alias("lo"), hi.alias("hi"))
        .withColumn("step", step)
        .select("feature", F.concat(inner, F.array("hi")).alias("bins"))
    )


def bin_of(value: Column, edges: Column) -> Column:
    """1-based bin of a value inside the edges; the last bin is closed on both sides.

    Counts the edges at or below the value, which agrees with binary search on every edge.
    """
    return F.least(F.size(F.filter(edges, lambda e: e <= value)), F.size(edges) - 1)


def bin_counts(df: DataFrame, edges: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``edges`` plus ``counts``: rows per bin as an array, one row per feature.

    Values outside the edges are dropped. ``edges`` has one row per column of the schema, so
    it is broadcast. ``columns`` names its features where they are known; otherwise they are
    looked up.
    """
    if columns is None:
        columns = [r["feature"] for r in edges.select("feature").collect()]
    missing = missing_columns(df, columns)
    if missing:
        raise ContractError(f"histogram columns missing: {missing}")
    tall = long_form(df, [], columns).join(F.broadcast(edges.select("feature", "bins")), "feature")
    inside = tall.filter(F.col("value").between(F.element_at("bins", 1), F.element_at("bins", -1)))
    counted = inside.groupBy("feature", bin_of(F.col("value"), F.col("bins")).alias("bin")).agg(F.count("*").alias("n"))
    return with_counts(edges, counted)


def with_counts(edges: DataFrame, counted: DataFrame) -> DataFrame:
    """``edges`` plus ``counts`` from (feature, bin, n); a bin that is not counted has 0."""
    # At most one entry per bin from here on.
    found = counted.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"))
    filled = "transform(sequence(1, size(bins) - 1), i -> coalesce(try_element_at(_n, i), 0L)) AS counts"
    return edges.join(F.broadcast(found), "feature", "left").selectExpr(*[f"`{c}`" for c in edges.columns], filled)


# Fractions of the values inside the edges; a feature without any has fractions of 0.
_TOTAL = "greatest(aggregate(counts, 0L, (a, n) -> a + n), 1L)"
_FRACTIONS = f"transform(counts, n -> n / {_TOTAL})"


def binned_counts(df: DataFrame, edges: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, bin, lo, hi, n, frac) on given edges, empty bins included."""
    return bins_of(bin_counts(df, edges, columns))


def bins_of(counted: DataFrame) -> DataFrame:
    """One row per bin from ``counts`` on edges."""
    per_feature = counted.selectExpr("feature", "bins", "counts", f"{_FRACTIONS} AS fracs")
    bins = per_feature.selectExpr("feature", "bins", "fracs", "posexplode(counts) AS (i, n)")
    return bins.selectExpr(
        "feature", "i + 1 AS bin", "get(bins, i) AS lo", "get(bins, i + 1) AS hi", "n", "get(fracs, i) AS frac"
    )


def equal_width_histogram(df: DataFrame, columns: list[str], bins: int = 5) -> DataFrame:
    """Histogram with n equal bins between minimum and maximum, per column."""
    columns = numeric_columns(df, columns)
    return binned_counts(df, equal_width_edges(df, columns, bins), columns)


def baseline_stats(df: DataFrame, columns: list[str], bins: int = 5) -> DataFrame:
    """(feature, bins, ref): edges and bin fractions of every numeric, non-empty column."""
    columns = numeric_columns(df, columns)
    counted = bin_counts(df, equal_width_edges(df, columns, bins), columns)
    return fractions_of(counted, "ref")


def fractions_of(counted: DataFrame, name: str) -> DataFrame:
    """(feature, bins) and the fractions of the counts inside the edges."""
    return counted.selectExpr("feature", "bins", f"{_FRACTIONS} AS {name}")


def drift_scores(df: DataFrame, baseline: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, psi, ks) of a frame against a baseline table.

    PSI is the population stability index with a small constant inside the logarithm. KS is
    the largest distance of the cumulative bin fractions; it is 0 if no value is in range.
    """
    return scores_of(bin_counts(df, baseline, columns))


def scores_of(counted: DataFrame) -> DataFrame:
    """(feature, psi, ks) of counts on the edges of a baseline."""
    e = f"{PSI_EPSILON}D"
    terms = f"zip_with(ref, cur, (r, c) -> (r - c) * ln((r + {e}) / (c + {e})))"
    gaps = "zip_with(ref, cur, (r, c) -> r - c)"
    walk = "named_struct('at', s.at + d, 'far', greatest(s.far, abs(s.at + d)))"
    return (
        counted.selectExpr("feature", "ref", "counts", f"{_FRACTIONS} AS cur")
        .selectExpr(
            "feature",
            f"aggregate({terms}, 0D, (a, t) -> a + t) AS psi",
            f"""CASE WHEN exists(counts, n -> n > 0)
                THEN aggregate({gaps}, named_struct('at', 0D, 'far', 0D), (s, d) -> {walk}, s -> s.far)
                ELSE 0D END AS ks""",
        )
    )


def drift_report(
    df: DataFrame,
    baseline: DataFrame,
    psi_limit: float = PSI_LIMIT,
    ks_limit: float = KS_LIMIT,
    columns: list[str] | None = None,
) -> DataFrame:
    """Scores with a verdict per feature."""
    return verdicts(drift_scores(df, baseline, columns), psi_limit, ks_limit)


def verdicts(scores: DataFrame, psi_limit: float = PSI_LIMIT, ks_limit: float = KS_LIMIT) -> DataFrame:
    return scores.withColumn("drifted", (F.col("psi") > psi_limit) | (F.col("ks") > ks_limit))


def check_drift(df: DataFrame, baseline: DataFrame, psi_limit: float = PSI_LIMIT, ks_limit: float = KS_LIMIT) -> None:
    """Raise if a feature drifted; the report has one row per column, so it is collected."""
    bad = drift_report(df, baseline, psi_limit, ks_limit).filter("drifted").orderBy("feature").collect()
    if bad:
        text = ", ".join(f"{r['feature']} (PSI={r['psi']:.3f}, KS={r['ks']:.3f})" for r in bad)
        raise DriftDetected(f"drift on {text}")
