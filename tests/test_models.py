"""Models, registry, jobs and gates on small synthetic data."""

import json
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from aerocast.contract import FEATURES, HAZARD, TARGET, ContractError, feature_columns
from aerocast.models import registry
from aerocast.models.training import fit_preprocessor, impute_values, score, train_all, train_current_level
from aerocast.operators.drift import baseline_stats
from aerocast.operators.readings import numeric_measures
from aerocast.operators.series import forecast_features
from aerocast.plans import quality, serve, training
from aerocast.session import materialise
from aerocast.sources.files import write_csv
from aerocast.sources.records import latest_run, load_baseline, read_record, run_log
from aerocast.sources.synthetic import synthetic_readings

pytestmark = pytest.mark.ml
CUTOFF = "2024-01-06 00:00:00"
SMALL = {"trees": 5, "depth": 4}


@pytest.fixture(scope="module")
def table(spark):
    return materialise(forecast_features(synthetic_readings(spark, 600)), "test-features")


@pytest.fixture(scope="module")
def models(table):
    return train_all(table, **SMALL)


def test_feature_list(table):
    assert sorted(feature_columns(table)) == sorted(FEATURES)


def test_scores_are_in_range(table, models):
    scored = score(table, models)
    assert scored.columns == [*table.columns, "aqi_3h", "hazard_class", "hazard_prob", "severity_model"]
    assert scored.count() == table.count()
    bad = "aqi_3h NOT BETWEEN 1 AND 5 OR hazard_prob NOT BETWEEN 0 AND 1 OR severity_model NOT BETWEEN 0 AND 3"
    assert scored.filter(bad).isEmpty()
    mae = scored.agg(F.avg(F.abs(F.col(TARGET) - F.col("aqi_3h")))).first()[0]
    assert mae < table.agg(F.avg(F.abs(F.col(TARGET) - 3.0))).first()[0]


def test_preprocessor(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 4.0), ("b", None)]
    df = spark.createDataFrame(rows, "city string, x double")
    assert impute_values(df, ["x", "city"]) == {"x": 2.5, "city": "b"}
    fitted = fit_preprocessor(df, ["x", "city"])
    other = spark.createDataFrame([("new", None), ("a", 2.5), (None, 2.5)], "city string, x double")
    vectors = [r["features"].toArray().tolist() for r in fitted.transform(other).collect()]
    assert vectors == [[0.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    scaled = [r["features"][0] for r in fitted.transform(df).collect()]
    deviation = math.sqrt(sum((x - 2.5) ** 2 for x in (1, 2, 3, 4, 2.5)) / 5)
    assert scaled == pytest.approx([(x - 2.5) / deviation for x in (1, 2, 3, 4, 2.5)])


def test_current_level_model(table):
    model = train_current_level(table, 5, 4)
    assert score(table, {"regressor": model}).filter("aqi_3h NOT BETWEEN 1 AND 5").isEmpty()


def named(name: str) -> PipelineModel:
    """A model that only tells which one it is."""
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, '{name}' AS source FROM __THIS__")])


def name_of(spark, model) -> str:
    return model.transform(spark.range(1)).first()["source"]


def test_registry_prefers_production(spark, tmp_path):
    root = f"{tmp_path}/models"
    with pytest.raises(registry.MissingModel):
        registry.load_model(spark, root, "regressor")
    paths = registry.save_models(spark, {"regressor": named("base"), "classifier": named("base")}, root, {"n": 1})
    assert name_of(spark, registry.load_model(spark, root, "regressor")) == "base"
    with pytest.raises(registry.MissingModel):
        registry.load_production(spark, root)
    for run in ("run-6", "run-7"):  # a second promotion replaces the first
        produced = registry.promote(spark, paths, root, {"rmse": 1.0}, run)
    record = read_record(spark, produced["metadata"])
    assert (record["training_run_id"], record["metrics"], record["n"]) == ("run-7", {"rmse": 1.0}, 1)
    assert set(registry.load_production(spark, root)[0]) == {"regressor", "classifier"}
    assert registry.model_path(spark, root, "regressor") == produced["regressor"]
    newer = {"regressor": named("production"), "classifier": named("production")}
    registry.save_production(spark, newer, root, {})
    assert name_of(spark, registry.load_model(spark, root, "regressor")) == "production"
    assert set(registry.load_models(spark, root)) == {"regressor", "classifier"}


def test_failed_copy_keeps_the_current_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    paths = registry.save_models(spark, {r: named("base") for r in registry.ROLES}, root, {})
    first = registry.promote(spark, paths, root, {}, "run-1")
    real, calls = registry.copy_tree, []

    def breaks(spark, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("disk full")
        real(spark, source, target)

    monkeypatch.setattr(registry, "copy_tree", breaks)
    with pytest.raises(OSError):
        registry.promote(spark, paths, root, {}, "run-2")
    assert registry.model_path(spark, root, "regressor") == first["regressor"]
    assert read_record(spark, f"{registry.production_path(spark, root)}/metadata")["training_run_id"] == "run-1"


def test_a_version_without_a_recommender_takes_no_older_one(spark, tmp_path):
    root = str(tmp_path)
    paths = registry.save_models(spark, {r: named("old") for r in registry.ROLES}, root, {})
    registry.promote(spark, paths, root, {}, "run-1")
    registry.save_production(spark, {"regressor": named("new"), "classifier": named("new")}, root, {})
    assert set(registry.load_models(spark, root)) == {"regressor", "classifier"}


def test_incomplete_production_falls_back(spark, tmp_path):
    registry.save_models(spark, {"regressor": named("base")}, str(tmp_path), {})
    (tmp_path / "production" / "v-1" / "regressor").mkdir(parents=True)
    registry.switch_production(spark, f"{tmp_path}/production", "v-1")
    assert name_of(spark, registry.load_model(spark, str(tmp_path), "regressor")) == "base"
    # A store that is there but broken is an error, not a reason to serve something else.
    broken = registry.save_production(spark, {"regressor": named("new")}, str(tmp_path), {})
    for part in (tmp_path / broken["regressor"] / "stages").glob("*/metadata/part-*"):
        part.write_text("{")
    for crc in (tmp_path / broken["regressor"] / "stages").glob("*/metadata/.part-*"):
        crc.unlink()
    with pytest.raises(Exception, match="JSON|parse|Expect|end-of-input|delim"):
        registry.load_model(spark, str(tmp_path), "regressor")


def test_stored_models_score_alike(spark, table, models, tmp_path):
    registry.save_models(spark, models, str(tmp_path), {})
    again = registry.load_models(spark, str(tmp_path))
    assert score(table, models).exceptAll(score(table, again)).isEmpty()


def test_training_run(spark, tmp_path):
    source = f"{tmp_path}/source"
    synthetic_readings(spark, 600).write.parquet(source)
    done = training.training_run(spark, ["/nowhere", source], str(tmp_path), CUTOFF, **SMALL)
    found = done["metrics"]
    assert set(found["regression"]) == {"mse", "rmse", "mae", "r2"}
    assert 0 <= found["classification"]["f1"] <= 1 and 0 <= found["recommender"]["accuracy"] <= 1
    assert sum(map(sum, found["classification"]["confusion_matrix"])) > 100
    assert latest_run(run_log(spark, f"{tmp_path}/runs")).first()["reg_r2"] == pytest.approx(found["regression"]["r2"])
    assert load_baseline(spark, f"{tmp_path}/baseline").count() == 32
    record = read_record(spark, done["paths"]["metadata"])
    assert set(record["periods"]) == {"train", "val"} and len(record["feature_columns"]) == 33
    test = training.evaluate_on_test(spark, source, f"{tmp_path}/models")
    assert test["classification"]["roc_auc"] > 0.5
    with pytest.raises(ContractError):
        training.check_feature_list(spark.createDataFrame([(1,)], "x int"), record["feature_columns"])


def test_offline_flow(spark, tmp_path):
    source = f"{tmp_path}/source"
    synthetic_readings(spark, 600).write.parquet(source)
    built = training.build_offline_features(spark, source, f"{tmp_path}/features")
    found = training.train_from_table(spark, built, f"{tmp_path}/models", CUTOFF, **SMALL)
    assert found["regression"]["rmse"] < 2
    assert registry.load_production(spark, f"{tmp_path}/models")[1]["periods"]["train"]["rows"] > 0


def test_behaviour_gate(spark, table, models):
    quality.check_model_behaviour(spark, models)
    rows = numeric_measures(table)
    baseline = materialise(baseline_stats(rows, feature_columns(rows)), "baseline")
    quality.run_checks(rows, baseline, models)
    with pytest.raises(ContractError, match="drift"):
        quality.run_checks(rows.withColumn("temperature_2m", F.col("temperature_2m") + 30), baseline)


def test_quality_suites(table):
    found = {(r["finding"], r["subject"]): r["amount"] for r in quality.integrity_profile(table).collect()}
    assert found[("nulls", "city")] == 0 and found[("duplicate keys", "*")] == 0
    assert found[("single value", "month")] == 1 and found[("conflicting labels", HAZARD)] == 0
    report = quality.balanced_model_report(table, 5, 4)
    assert report["roc_auc"] > 0.5


def test_csv_scoring_covers_every_row(spark, table, models, tmp_path):
    write_csv(table.select(*FEATURES).limit(40), f"{tmp_path}/in")
    records = serve.score_csv(spark, f"{tmp_path}/in", models)
    assert records.count() == 40
    first = json.loads(records.toJSON().first())
    assert set(first) == {"city", "prediction", "meta", "recommendations"}
    assert first["recommendations"]["headline"]


def test_live_observation_scoring(spark, models):
    time = "TIMESTAMP_NTZ '2024-01-01 05:00:00'"
    poll = spark.sql(
        f"""SELECT city, 4D AS main_aqi, 1D AS components_co, .1D AS components_no, CAST(NULL AS DOUBLE) AS components_no2,
            .3D AS components_o3, .4D AS components_so2, 10D AS components_pm2_5, 20D AS components_pm10, .5D AS components_nh3,
            {time} AS observed_at_local FROM VALUES ('Islamabad '), ('Unknown') AS t(city)"""
    )
    weather = spark.sql(
        f"""SELECT city, {time} AS datetime, 25D AS temperature_2m, 50D AS relative_humidity_2m, 10D AS dew_point_2m,
            0D AS precipitation, 1000D AS surface_pressure, 2D AS wind_speed_10m, 180D AS wind_direction_10m,
            100D AS shortwave_radiation FROM VALUES ('islamabad'), ('Unknown') AS t(city)"""
    )
    older = poll.withColumns({"main_aqi": F.lit(1.0), "observed_at_local": F.expr("observed_at_local - INTERVAL 1 HOUR")})
    many = weather.unionAll(weather.withColumn("datetime", F.expr("datetime - INTERVAL 2 HOUR")))
    rows = serve.score_observations(older.unionAll(poll), many, models, "stored/tree").collect()
    assert len(rows) == 1
    row = rows[0].asDict(recursive=True)
    assert row["city"] == "Islamabad" and row["prediction"]["hazard_label"] in ("Hazardous", "Safe / Moderate")
    assert str(row["realtime"]["predicted_for_local"]) == "2024-01-01 08:00:00"
    assert row["recommendations"]["based_on"]["current_aqi"] == 4.0
    assert row["recommendations"]["based_on"]["recommender_model"] == "stored/tree"
