"""Quality gates: data integrity, drift, model behaviour."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.contract import FEATURES, HAZARD, ContractError
from aerocast.models.training import score, train_classifier
from aerocast.operators.checks import check_integrity, check_predictions
from aerocast.operators.drift import check_drift
from aerocast.operators.profile import conflicting_labels
from aerocast.operators.sampling import balanced_sample
from aerocast.operators.scoring import prediction_records
from aerocast.plans.evaluate import evaluate
from aerocast.session import materialise

# --- Fixed values: the canonical row that a sane model must handle. ---
CANONICAL_ROW = {
    "main_aqi": 3.0,
    "components_co": 0.5,
    "components_no": 0.05,
    "components_no2": 0.1,
    "components_o3": 0.2,
    "components_so2": 0.05,
    "components_pm2_5": 15.0,
    "components_pm10": 30.0,
    "components_nh3": 0.05,
    "temperature_2m": 25.0,
    "relative_humidity_2m": 50.0,
    "dew_point_2m": 10.0,
    "precipitation": 0.0,
    "surface_pressure": 1000.0,
    "wind_speed_10m": 2.0,
    "wind_direction_10m": 180.0,
    "shortwave_radiation": 100.0,
    "city": "Islamabad",
    "hour": 12,
    "dayofweek": 1,
    "month": 6,
    "is_weekend": 0,
}
# --- Fixed values: columns of the quality suites. ---
SUITE_FEATURES = [
    "main_aqi",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
    "wind_direction_10m",
    "shortwave_radiation",
    "hour",
    "month",
    "city",
]


def canonical_features(spark: SparkSession) -> DataFrame:
    """The canonical row with lags and means equal to the current values."""
    row = dict(CANONICAL_ROW)
    for c in FEATURES:
        if c not in row:
            row[c] = row[c.split("_lag_")[0].removesuffix("_roll3_mean")]
    kinds = {"city": "string", **dict.fromkeys(("hour", "dayofweek", "month", "is_weekend"), "int")}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in FEATURES)
    return spark.createDataFrame([tuple(row[c] for c in FEATURES)], schema)


def check_model_behaviour(spark: SparkSession, models: dict[str, PipelineModel]) -> None:
    """Level within 1..5, probability within 0..1, advice with a headline, on the canonical row."""
    scored = score(canonical_features(spark), models)
    check_predictions(scored, "aqi_3h")
    if "hazard_prob" in scored.columns:
        check_predictions(scored, "hazard_prob", 0.0, 1.0)
    if prediction_records(scored).filter(F.length("recommendations.headline") > 0).isEmpty():
        raise ContractError("recommendations lack a headline")


def run_checks(sample: DataFrame, baseline: DataFrame, models: dict[str, PipelineModel] | None = None) -> None:
    """All gates in turn; the first failure raises. Without models the last gate is skipped."""
    check_integrity(sample)
    check_drift(sample, baseline)
    if models:
        check_model_behaviour(sample.sparkSession, models)


def integrity_profile(df: DataFrame, label: str = HAZARD) -> DataFrame:
    """(finding, subject, amount) over the suite columns: nulls, copies, constants, label conflicts.

    Three passes over the input, one per grouping; store it first if its plan is expensive.
    Identical feature rows at different times are ordinary readings, so copies are counted on
    the key where there is one.
    """
    features = [c for c in SUITE_FEATURES if c in df.columns]
    columns = [*features, label]
    keys = ("city", "datetime") if {"city", "datetime"} <= set(df.columns) else tuple(features)

    def finding(name: str, subject: str, amount) -> Column:
        named = (F.lit(name).alias("finding"), F.lit(subject).alias("subject"))
        return F.struct(*named, amount.cast("bigint").alias("amount"))

    counts = []
    for c in columns:
        alone = F.min(c).eqNullSafe(F.max(c)) & ((F.count(c) == 0) | (F.count(c) == F.count("*")))
        counts += [F.count_if(F.col(c).isNull()).alias(f"nulls|{c}"), alone.alias(f"single|{c}")]
    one = df.agg(*counts)
    cells = [finding("nulls", c, F.col(f"`nulls|{c}`")) for c in columns]
    # A column with several values gives a null struct, which is filtered out.
    cells += [F.when(F.col(f"`single|{c}`"), finding("single value", c, F.lit(1))) for c in columns]
    by_column = one.select(F.explode(F.array(*cells)).alias("f")).filter("f IS NOT NULL").select("f.*")

    copies = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    conflicts = conflicting_labels(df, features, label)
    by_key = copies.select(finding("duplicate keys", "*", F.col("n")).alias("f")).select("f.*")
    by_label = conflicts.select(finding("conflicting labels", label, F.col("n_conflicts")).alias("f")).select("f.*")
    return by_column.unionByName(by_key).unionByName(by_label)


def balanced_model_report(df: DataFrame, trees: int = 200, depth: int = 12) -> dict:
    """Fit and evaluate the hazard model on a label-balanced sample of the suite columns.

    The sample has as many rows of each label as the rarest label has; there is no other bound.
    """
    features = [c for c in SUITE_FEATURES if c in df.columns]
    even = materialise(balanced_sample(df, HAZARD), "balanced")
    model = train_classifier(even, features, trees=trees, depth=depth, balanced=False)
    return evaluate(materialise(score(even, {"classifier": model}), "balanced-scored"))["classification"]
