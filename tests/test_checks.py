"""Validation rules on the small frames they were designed for."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerocast.contract import FEATURES, ContractError
from aerocast.operators import checks
from aerocast.plans.quality import canonical_features

RAW = "city string, datetime timestamp_ntz, main_aqi double, components_pm2_5 double, components_pm10 double"
GOOD = [("islamabad", datetime(2024, 1, 1), 3.0, 15.0, 30.0), ("lahore", datetime(2024, 1, 2), 4.5, 20.0, 40.0)]


def test_raw_check(spark):
    df = spark.createDataFrame(GOOD, RAW)
    checks.check_raw(df)
    checks.check_integrity(df)
    with pytest.raises(ContractError, match="range:main_aqi"):
        checks.check_raw(df.withColumn("main_aqi", F.lit(6.0)))
    with pytest.raises(ContractError, match="null:components_pm10"):
        checks.check_raw(df.withColumn("components_pm10", F.lit(float("nan"))))
    with pytest.raises(ContractError, match="datetime"):
        checks.check_raw(spark.createDataFrame([("islamabad", 3.0)], "city string, main_aqi double"))


def test_feature_check(spark):
    schema = "f1 int, f2 int, main_aqi_t_plus_h double, hazard_t_plus_h int"
    checks.check_features(spark.createDataFrame([(1, 3, 1.5, 0), (2, 4, 4.5, 1)], schema))
    with pytest.raises(ContractError, match="label"):
        checks.check_features(spark.createDataFrame([(1, 3, 2.0, 2)], schema))
    with pytest.raises(ContractError, match="null:f2"):
        checks.check_features(spark.createDataFrame([(1, None, 2.0, 1)], schema))


def test_integrity_covers_labels(spark):
    df = spark.createDataFrame(GOOD, RAW).withColumn("hazard_t_plus_h", F.lit(2))
    with pytest.raises(ContractError, match="label"):
        checks.check_integrity(df)


def test_prediction_check(spark):
    df = spark.createDataFrame([(1,), (2,)], "f int")
    checks.check_predictions(df.withColumn("prediction", F.lit(3.5)))
    with pytest.raises(ContractError, match="range"):
        checks.check_predictions(df.withColumn("prediction", F.lit(6.0)))
    with pytest.raises(ContractError, match="missing"):
        checks.check_predictions(df.withColumn("prediction", F.lit(float("nan"))))


def test_serving_contract(spark):
    row = canonical_features(spark)
    assert row.columns == FEATURES and len(FEATURES) == 33
    checks.check_serving_contract(row)
    with pytest.raises(ContractError, match="month"):
        checks.check_serving_contract(row.drop("month"))
