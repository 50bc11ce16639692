"""Quality of scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.contract import HAZARD, TARGET, ContractError, missing_columns
from aerocast.functions.labels import severity_bucket
from aerocast.operators.metrics import classification_aggregates, regression_aggregates
from aerocast.operators.ordered import area_under_curve


def evaluate(scored: DataFrame) -> dict[str, dict]:
    """Metrics of the models present in a scored frame.

    ``scored`` is read twice (one aggregation for all metrics, one for the rank sums), so pass
    a stored table when scoring is expensive. Only the metric values come to the driver.
    """
    has, aggs = set(scored.columns), []
    if "aqi_3h" in has:
        aggs += regression_aggregates(F.col(TARGET), F.col("aqi_3h"))
    if "hazard_class" in has:
        aggs += classification_aggregates(F.col(HAZARD), F.col("hazard_class"))
    if "severity_model" in has:
        same = severity_bucket(F.col(TARGET)) == F.col("severity_model")
        aggs.append(F.avg(same.cast("double")).alias("severity_accuracy"))
    found = scored.agg(*aggs).first().asDict()

    out = {}
    if "aqi_3h" in has:
        out["regression"] = {m: found[m] for m in ("mse", "rmse", "mae", "r2")}
    if "hazard_class" in has:
        out["classification"] = {
            "accuracy": found["accuracy"],
            "f1": found["f1"],
            "confusion_matrix": [[found["tn"], found["fp"]], [found["fn"], found["tp"]]],
            "roc_auc": area_under_curve(scored, HAZARD, "hazard_prob").first()["roc_auc"],
        }
    if "severity_model" in has:
        out["recommender"] = {"accuracy": found["severity_accuracy"]}
    return out


def check_feature_list(df: DataFrame, expected: list[str]) -> None:
    missing = missing_columns(df, expected)
    if missing:
        raise ContractError(f"the stored models need columns that the table lacks: {missing}")


def persistence_forecast(features: DataFrame) -> DataFrame:
    """The naive forecast: the level stays as it is. Gives every metric a model-free input."""
    return features.withColumns(
        {
            "aqi_3h": F.col("main_aqi"),
            "hazard_class": (F.col("main_aqi") >= 4).cast("int"),
            "hazard_prob": (F.col("main_aqi") - 1) / 4,
            "severity_model": severity_bucket(F.col("main_aqi")),
        }
    )
