"""Cleaning, keys, filters and joins on hand-made frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerocast.contract import ContractError
from aerocast.operators import readings as rd
from aerocast.operators import splits

T0 = datetime(2024, 1, 1)


def hour(h, day=1):
    return datetime(2024, 1, day, h)


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` components.co ` int, city int")
    assert rd.standard_headers(df).columns == ["components_co", "city"]


def test_first_row_of_a_key_wins_and_nulls_stay(spark):
    rows = [("a", T0, None, 5), ("a", T0, 1.0, 7), ("a", T0, 2.0, None), ("b", T0, 3.0, None)]
    df = spark.createDataFrame(rows, "city string, datetime timestamp_ntz, main_aqi double, id bigint").repartition(3)
    got = {r["city"]: r["main_aqi"] for r in rd.first_per_key(df, order="id").collect()}
    assert got == {"a": None, "b": 3.0}


def test_rows_without_a_place_come_last(spark):
    rows = [("a", T0, 1.0, None), ("a", T0, 2.0, 9), ("b", T0, 3.0, None), ("b", T0, 4.0, None)]
    df = spark.createDataFrame(rows, "city string, datetime timestamp_ntz, x double, row_order bigint")
    got = {r["city"]: r["x"] for r in rd.first_per_key(df.repartition(3)).collect()}
    again = {r["city"]: r["x"] for r in rd.first_per_key(df.coalesce(1)).collect()}
    assert got == again and got["a"] == 2.0 and got["b"] in (3.0, 4.0)
    with pytest.raises(ContractError, match="row_order"):
        rd.first_per_key(df.drop("row_order"))


def test_first_rows_are_found_by_hashing(spark):
    rows = spark.range(100).selectExpr(
        "string(id % 5) AS city", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS datetime", "double(id) AS x", "id AS row_order"
    )
    plan = rd.first_per_key(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_clean_readings(spark):
    rows = [
        ("Lahore", "2024-01-01 05:00:00", "3.5", "n/a"),
        ("lahore ", "01/01/2024 05:00", "1.5", "2"),
        ("Lahore", "never", "1", "1"),
        (None, "2024-01-01 05:00:00", "1", "1"),
        ("QUETTA", "2024-01-01 06:00:00", "NaN", "7"),
    ]
    numbered = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, "city string, datetime string, main_aqi string, `components.pm10` string, row_order bigint")
    got = sorted(map(tuple, rd.clean_readings(df).collect()))
    assert got == [("Lahore", hour(5), 3.5, None), ("Quetta", hour(6), None, 7.0)]


def test_zoned_time_keeps_the_wall_clock(spark):
    df = spark.sql("SELECT 'a' AS city, TIMESTAMP '2024-01-01 05:00:00' AS datetime")
    assert rd.parse_datetime(df).first()["datetime"] == hour(5)


def test_align_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, "a")], "x int, extra int, y int, city string")
    assert rd.align_columns(df, ["y", "x"]).columns == ["y", "x", "city"]
    with pytest.raises(ContractError, match="z"):
        rd.align_columns(df, ["x", "z"])


def test_city_forms_and_support(spark):
    df = spark.createDataFrame([(" LAHORE ",), ("quetta",), ("Multan",), (None,)], "city string")
    kept = rd.supported_cities(df).select(rd.city_name(F.col("city"))).collect()
    assert sorted(r[0] for r in kept) == ["Lahore", "Quetta"]
    assert {r["city"] for r in rd.unsupported_cities(df).collect()} == {"Multan", None}
    found = {r["city_key"]: r["lat"] for r in rd.with_coordinates(df).collect()}
    assert found == {"lahore": 31.5204, "quetta": 30.1798, "multan": None, None: None}


def test_cutoff_is_inclusive(spark):
    df = spark.createDataFrame([(datetime(2024, 6, 30, 23),), (datetime(2024, 7, 1),)], "datetime timestamp_ntz")
    assert rd.before_cutoff(df).count() == 1


def test_trailing_days_has_a_strict_bound(spark):
    df = spark.range(24 * 10).selectExpr("'a' AS city", "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS datetime")
    assert rd.trailing_days(df, 7).count() == 168


def test_latest_observation_join(spark):
    left = spark.createDataFrame([("a", hour(1), 1.0), ("a", hour(3), 3.0), ("b", hour(1), 9.0)], "city string, datetime timestamp_ntz, p double")
    right = spark.createDataFrame([("a", hour(2), 2.0), ("a", hour(0), 7.0)], "city string, datetime timestamp_ntz, w double")
    assert [tuple(r) for r in rd.join_observations(left, right).collect()] == [("a", hour(3), 3.0, hour(2), 2.0)]


def test_split_and_empty_side(spark):
    df = spark.createDataFrame([(hour(1),), (hour(2),)], "datetime timestamp_ntz")
    train, val = splits.train_val(df, "2024-01-01 01:00:00")
    assert (train.count(), val.count()) == (1, 1)
    with pytest.raises(ContractError, match="val"):
        splits.train_val(df, "2024-01-01 02:00:00")


def test_missing_pollutant_is_zero(spark):
    df = spark.createDataFrame([(None, 2.0)], "components_co double, components_no double")
    assert tuple(rd.coalesce_pollutants(df, ["components_co", "components_no"]).first()) == (0.0, 2.0)
