"""Forecast quality metrics, each in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.functions.labels import clip, severity_bucket

ALL = "(all)"


def regression_aggregates(y: Column, p: Column) -> list[Column]:
    """mse, rmse, mae and r2 of a prediction column."""
    mse = F.avg((y - p) * (y - p))
    spread = F.var_pop(y)
    r2 = F.when(F.count(y) < 2, F.lit(None)).when(spread > 0, 1 - mse / spread).when(mse == 0, 1.0).otherwise(0.0)
    return [mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(y - p)).alias("mae"), r2.cast("double").alias("r2")]


def _cell(y: Column, p: Column, actual: int, predicted: int) -> Column:
    return F.count_if((y == actual) & (p == predicted))


def classification_aggregates(y: Column, p: Column) -> list[Column]:
    """accuracy, F1 of class 1 (0 if undefined) and the 2 x 2 confusion counts."""
    tn, fp, fn, tp = (_cell(y, p, a, b) for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)))
    hits = 2 * tp + fp + fn
    return [
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.when(hits > 0, 2 * tp / hits).otherwise(0.0).alias("f1"),
        tn.alias("tn"),
        fp.alias("fp"),
        fn.alias("fn"),
        tp.alias("tp"),
    ]


def regression_metrics(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n"), *regression_aggregates(F.col(y), F.col(p)))


def classification_metrics(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n"), *classification_aggregates(F.col(y), F.col(p)))


def metrics_by_city(df: DataFrame, y: str, p: str, label: str, predicted: str) -> DataFrame:
    """Regression and classification metrics overall and per city in one pass."""
    aggs = [F.count("*").alias("n"), *regression_aggregates(F.col(y), F.col(p))]
    aggs += classification_aggregates(F.col(label), F.col(predicted))[:2]
    grouped = df.groupingSets([[], [F.col("city")]], F.col("city")).agg(F.grouping("city").alias("_g"), *aggs)
    scope = F.when(F.col("_g") == 1, F.lit(ALL)).otherwise(F.col("city"))
    return grouped.select(scope.alias("scope"), "n", "mse", "rmse", "mae", "r2", "accuracy", "f1")


def level_accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """Share of predictions whose rounded, limited level equals the truncated true level."""
    level = clip(F.bround(F.col(p)), 1.0, 5.0).cast("int")
    return df.agg(F.avg((level == F.col(y).cast("int")).cast("double")).alias("level_accuracy"))


def severity_accuracy(df: DataFrame, y: str, bucket: Column) -> DataFrame:
    """Share of rows whose predicted severity bucket is the bucket of the true level."""
    return df.agg(F.avg((severity_bucket(F.col(y)) == bucket).cast("double")).alias("severity_accuracy"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the size of the smallest class."""
    # The window runs over one row per class.
    return df.groupBy(label).agg(F.count("*").alias("n")).selectExpr("*", "min(n) OVER () AS smallest")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_class), one row per class."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    return counted.selectExpr("*", "sum(n) OVER () / (count(*) OVER () * n) AS weight")


def scoring_counters(log: DataFrame) -> DataFrame:
    """Requests, successes and failures, overall and per city; ``ok`` marks a success."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    grouped = log.groupingSets([[], [F.col("city")]], F.col("city")).agg(
        F.grouping("city").alias("_g"),
        F.count("*").alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
    )
    scope = F.when(F.col("_g") == 1, F.lit(ALL)).otherwise(F.col("city"))
    return grouped.select(scope.alias("scope"), "total", "successful", "failed")
