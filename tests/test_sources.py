"""Files, payloads and records in temporary folders."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerocast.contract import FEATURES, MEASURES, ContractError
from aerocast.operators.drift import baseline_stats
from aerocast.plans.quality import canonical_features
from aerocast.sources import files, payloads, records
from aerocast.sources.synthetic import synthetic_readings


@pytest.fixture
def city_files(tmp_path):
    (tmp_path / "one.csv").write_text(
        "datetime,main_aqi,components.co\n2024-06-30 23:00:00,3,1.5\n2024-07-01 00:00:00,4,2\nbad,1,1\n30/06/2024 22:00,2,x\n"
    )
    (tmp_path / "two.csv").write_text("main_aqi,components.co,datetime,extra\n5,9,2024-01-01T04:00+05:00,7\n")
    (tmp_path / "three.csv").write_text("datetime,main_aqi,components.co\n2024-02-01 00:00:00,1,0.5\n")
    return {"lahore": f"{tmp_path}/one.csv", "quetta": f"{tmp_path}/two.csv", "karachi": f"{tmp_path}/three.csv"}


def test_unify_training(spark, city_files):
    rows = files.unify_training(spark, city_files).select("city", "datetime", "main_aqi", "components_co")
    assert sorted(map(tuple, rows.collect())) == [
        ("Karachi", datetime(2024, 2, 1), 1.0, 0.5),
        ("Lahore", datetime(2024, 6, 30, 22), 2.0, None),
        ("Lahore", datetime(2024, 6, 30, 23), 3.0, 1.5),
        ("Quetta", datetime(2024, 1, 1, 4), 5.0, 9.0),
    ]


def test_unify_test_follows_a_reference(spark, city_files, tmp_path):
    ref = f"{tmp_path}/ref"
    spark.createDataFrame([("a", "t", 1.0)], "city string, datetime string, main_aqi double").write.parquet(ref)
    assert files.column_names(spark, ref) == ["city", "datetime", "main_aqi"]
    rows = files.unify_test(spark, city_files, ref)
    assert rows.columns == ["datetime", "main_aqi", "city"] and rows.count() == 5
    spark.createDataFrame([("a", "t", 1.0)], "city string, datetime string, ozone double").write.parquet(f"{ref}2")
    with pytest.raises(ContractError, match="ozone"):
        files.unify_test(spark, city_files, f"{ref}2")


def test_missing_city_file(spark, city_files):
    with pytest.raises(FileNotFoundError, match="multan"):
        files.read_city_files(spark, {**city_files, "multan": "/nowhere/multan.csv"})


def test_first_existing_source(spark, city_files, tmp_path):
    sample = city_files["lahore"]
    assert files.first_existing(spark, ["/nowhere/full.parquet", sample]) == sample
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, ["/nowhere/full.parquet"])
    landed = files.land_first(spark, ["/nowhere/full.parquet", sample], f"{tmp_path}/landed")
    stored = spark.read.parquet(landed)
    assert stored.count() == 4
    assert [r["main_aqi"] for r in stored.orderBy("row_order").collect()] == ["3", "4", "1", "2"]


def test_first_row_of_the_source_wins(spark, tmp_path):
    """Repeats in several Parquet files, with missing values first."""
    rows = [(" lahore", "2024-01-01 00:00:00", None, 7.0), ("Lahore", "2024-01-01 00:00:00", 2.0, None), ("Lahore", "2024-01-01 01:00:00", 3.0, 1.0)]
    path = f"{tmp_path}/source"
    for part in (rows, list(reversed(rows))):
        frame = spark.createDataFrame(part, "city string, datetime string, main_aqi double, components_pm10 double")
        frame.coalesce(1).write.mode("append").parquet(path)
    first = sorted(spark.read.parquet(path).inputFiles())[0]
    want = [r for r in spark.read.parquet(first).collect() if r["datetime"].endswith("00:00:00") and r["datetime"][11] == "0"][0]
    for source in (path, files.land_first(spark, [path], f"{tmp_path}/landed")):
        got = files.load_readings(spark, [source]).orderBy("datetime").collect()
        assert [r["city"] for r in got] == ["Lahore", "Lahore"]
        assert (got[0]["main_aqi"], got[0]["components_pm10"]) == (want["main_aqi"], want["components_pm10"])


def test_landing_goes_on_where_it_ended(spark, tmp_path):
    """New files are added with growing places, known ones are left alone, a broken landing is done again."""
    root, source = f"{tmp_path}/landed", f"{tmp_path}/source"

    def arrive(name, rows):
        spark.createDataFrame(rows, "city string, datetime string, main_aqi string").coalesce(1).write.option("header", True).csv(f"{source}/{name}")
        return f"{source}/{name}"

    one = arrive("b", [("lahore", "2024-01-01 00:00:00", "1"), ("lahore", "2024-01-01 01:00:00", "2")])
    assert len(files.land_more(spark, [one], root)) == 1 and files.land_more(spark, [one], root) == []
    before = {r["main_aqi"]: r["row_order"] for r in files.read_landed(spark, root).collect()}
    # A row of a key that is there, under a name that sorts first, and a landing that never reached the log.
    two = arrive("a", [("Lahore ", "2024-01-01 00:00:00", "9"), ("lahore", "2024-01-01 02:00:00", "3")])
    spark.range(3).write.parquet(f"{root}/landing=1")
    assert files.read_landed(spark, root).count() == 2
    assert len(files.land_more(spark, [one, two], root)) == 1
    after = {r["main_aqi"]: r["row_order"] for r in files.read_landed(spark, root).collect()}
    assert {k: after[k] for k in before} == before and min(after["9"], after["3"]) > max(before.values())
    got = files.load_landed(spark, root).orderBy("datetime").collect()
    assert [(r["city"], r["main_aqi"]) for r in got] == [("Lahore", 1.0), ("Lahore", 2.0), ("Lahore", 3.0)]
    with pytest.raises(FileNotFoundError):
        files.read_landed(spark, f"{tmp_path}/nothing")


def test_layout_prunes_by_month_and_city(spark, tmp_path):
    path = files.write_by_month(synthetic_readings(spark, 300), f"{tmp_path}/laid")
    part = spark.read.parquet(path).filter("city = 'Lahore' AND month_part = '2024-01'")
    assert part.count() == 100
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_part" in plan and "EqualTo(city,Lahore)" in plan


def test_city_folders(spark, tmp_path):
    rows = synthetic_readings(spark, 60)
    paths = {c: files.write_csv(rows.filter(F.col("city") == c).drop("city").repartition(3), f"{tmp_path}/{c}") for c in ("Lahore", "Karachi")}
    got = files.unify_training(spark, paths)
    assert {r["city"]: r["count"] for r in got.groupBy("city").count().collect()} == {"Lahore": 20, "Karachi": 20}


def test_feature_csv(spark, tmp_path):
    path = files.write_csv(canonical_features(spark).withColumn("city", F.lit("islamabad ")), f"{tmp_path}/features")
    got = files.read_feature_csv(spark, path)
    assert got.first()["city"] == "Islamabad"
    assert got.columns == FEATURES and got.first()["components_pm10_lag_2"] == 30.0
    files.write_csv(canonical_features(spark).drop("hour"), f"{tmp_path}/short")
    with pytest.raises(ContractError, match="hour"):
        files.read_feature_csv(spark, f"{tmp_path}/short")


def test_pollutant_payload(spark):
    entry = {"main": {"aqi": 4}, "components": {"co": 1.0, "pm2_5": 10.0, "pm10": 20.0}, "dt": 1704067200}
    rows = [("a", json.dumps({"list": [entry, {"main": {"aqi": 1}}]})), ("b", json.dumps({"list": []})), ("c", "broken")]
    got = {r["city"]: r for r in payloads.pollutant_fields(spark.createDataFrame(rows, "city string, payload string")).collect()}
    assert got["a"]["main_aqi"] == 4.0 and got["a"]["components_pm10"] == 20.0 and got["a"]["components_nh3"] is None
    assert got["a"]["observed_at_local"] == datetime(2024, 1, 1, 5)
    assert got["b"]["main_aqi"] is None and got["c"]["observed_at_utc"] is None


def test_weather_payload(spark):
    hourly = {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [5.0, 6.5], "precipitation": [0.0]}
    df = spark.createDataFrame([("a", json.dumps({"hourly": hourly})), ("b", json.dumps({"hourly": {"time": []}}))], "city string, payload string")
    last = {r["city"]: r for r in payloads.weather_last(df).collect()}
    assert last["a"]["datetime"] == datetime(2024, 1, 1, 1) and last["a"]["temperature_2m"] == 6.5
    assert last["a"]["wind_speed_10m"] is None and last["b"]["datetime"] is None
    hours = payloads.weather_hours(df).orderBy("datetime").collect()
    assert [(r["temperature_2m"], r["precipitation"]) for r in hours] == [(5.0, 0.0), (6.5, None)]


def test_baseline_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i * 10.0) for i in range(1, 6)], "a double, b double")
    path = records.save_baseline(df, ["a", "b"], f"{tmp_path}/stats", 3)
    stored = records.load_baseline(spark, path)
    want = baseline_stats(df, ["a", "b"], 3)
    assert stored.count() == 2 and stored.exceptAll(want).isEmpty()
    with pytest.raises(FileNotFoundError):
        records.load_baseline(spark, f"{tmp_path}/nothing")


def test_production_info(spark, tmp_path):
    assert records.production_info(spark, f"{tmp_path}/none")["status"] == "no_production_metadata"
    path = records.write_record(spark, {"model_version": "test", "nested": {"a": [1, 2]}}, f"{tmp_path}/meta")
    assert records.production_info(spark, path) == {"model_version": "test", "nested": {"a": [1, 2]}}
    spark.createDataFrame([("{oops",)], "value string").write.text(f"{tmp_path}/bad")
    assert records.production_info(spark, f"{tmp_path}/bad")["status"] == "error"


def test_run_log(spark, tmp_path):
    path = f"{tmp_path}/runs"
    for i in (2, 3, 1):
        records.log_run(spark, path, f"run{i}", {"rmse": i / 10}, {}, {}, {"regressor": "r"}, at=f"2024-01-0{i}T00:00:00Z")
    log = records.run_log(spark, path)
    assert log.count() == 3
    last = records.latest_run(log).first()
    assert last["run_id"] == "run3" and last["reg_rmse"] == 0.3 and last["clf_f1"] is None and last["notes"] == ""


def test_synthetic_readings(spark):
    one = synthetic_readings(spark, 600)
    assert one.columns == ["city", "datetime", *MEASURES] and one.count() == 600
    assert one.exceptAll(synthetic_readings(spark, 600)).isEmpty()
    assert one.filter("main_aqi NOT BETWEEN 1 AND 5 OR components_pm10 NOT BETWEEN 0 AND 120 OR precipitation < 0").isEmpty()
    assert one.select("city", "datetime").distinct().count() == 600
    early = one.filter(F.col("datetime") < "2024-01-03").agg(F.avg("main_aqi")).first()[0]
    late = one.filter(F.col("datetime") > "2024-01-07").agg(F.avg("main_aqi")).first()[0]
    assert late > early
