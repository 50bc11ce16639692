"""Batch scoring jobs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.models.registry import load_models, model_paths
from aerocast.models.training import score
from aerocast.operators.checks import check_serving_contract
from aerocast.operators.readings import city_key, join_observations, supported_cities
from aerocast.operators.scoring import cold_start_features, prediction_records
from aerocast.sources.files import read_feature_csv


def serving_models(spark: SparkSession, root: str) -> tuple[dict[str, PipelineModel], str | None]:
    """The stored models and the path of the recommender, which records name as their origin."""
    return load_models(spark, root), model_paths(spark, root).get("recommender")


def score_features(df: DataFrame, models: dict[str, PipelineModel], recommender: str | None = None) -> DataFrame:
    """Prediction records for rows that carry all model inputs."""
    check_serving_contract(df)
    return prediction_records(score(df, models), recommender, observed=None)


def score_csv(spark: SparkSession, path: str, models: dict[str, PipelineModel], recommender: str | None = None) -> DataFrame:
    """Prediction records for every row of a feature CSV."""
    return score_features(read_feature_csv(spark, path), models, recommender)


def served_rows(pollutants: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per supported city: its newest pollutants and its newest weather, with model inputs.

    Both frames carry a city; unsupported cities are left out (see ``unsupported_cities`` for
    the rejects). The newest pollutants are those with the last ``observed_at_local``, the newest
    weather that with the last ``datetime``. Lags repeat the current value: there is no history here.
    """
    timed = pollutants.withColumn("datetime", F.col("observed_at_local"))
    left = supported_cities(timed).withColumn("city", city_key(F.col("city")))
    right = supported_cities(weather).withColumn("city", city_key(F.col("city")))
    newest = join_observations(left, right).drop("observed_at").withColumnRenamed("weather_at", "datetime")
    return cold_start_features(newest)


def score_observations(
    pollutants: DataFrame, weather: DataFrame, models: dict[str, PipelineModel], recommender: str | None = None
) -> DataFrame:
    """Prediction records from the newest pollutant and weather observation of each city."""
    rows = served_rows(pollutants, weather)
    check_serving_contract(rows)
    return prediction_records(score(rows, models), recommender, observed="observed_at_local")
