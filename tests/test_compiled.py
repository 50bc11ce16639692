"""Expressions compiled from fitted models against the pipelines themselves, in Spark and in DuckDB."""

import duckdb
import pytest
from pyspark.sql import functions as F

from aerocast.contract import HAZARD, TARGET
from aerocast.models.compiled import apply_compiled, as_sql, compile_model, fits
from aerocast.models.training import score, train_all, train_classifier, train_current_level, train_regressor
from aerocast.operators.series import forecast_features
from aerocast.session import materialise
from aerocast.sources.synthetic import synthetic_readings

pytestmark = pytest.mark.ml
PUBLISHED = ["aqi_3h", "hazard_class", "hazard_prob", "severity_model"]


@pytest.fixture(scope="module")
def table(spark):
    return materialise(forecast_features(synthetic_readings(spark, 500)), "compiled-features")


@pytest.fixture(scope="module")
def models(table):
    return train_all(table, trees=7, depth=5)


@pytest.fixture(scope="module")
def odd(table):
    """Rows as they are, and rows with nulls, NaN, infinities, unknown and missing cities."""
    holes = table.withColumns({c: F.when(F.rand(i) > 0.3, F.col(c)) for i, c in enumerate(table.columns) if c not in ("city", "datetime")})
    holes = holes.withColumn("city", F.expr("element_at(array('Lahore', 'it''s new', NULL, ''), 1 + CAST(hour AS INT) % 4)"))
    extreme = table.limit(60).withColumns({"main_aqi": F.lit(float("nan")), "components_co": F.lit(float("inf")), "temperature_2m": F.lit(float("-inf"))})
    both = table.unionByName(holes).unionByName(extreme)
    return materialise(both.withColumn("row", F.monotonically_increasing_id()), "odd-rows")


def test_same_numbers_as_the_pipelines(odd, models):
    assert all(fits(m.stages[-1]) for m in models.values())
    native, fitted = score(odd, models), score(odd, models, native=False)
    assert native.columns == fitted.columns == [*odd.columns, *PUBLISHED]
    columns = ["row", *PUBLISHED]
    assert native.select(columns).exceptAll(fitted.select(columns)).isEmpty() and native.count() == odd.count()


def _mode(df):
    return df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


def test_no_vectors_and_inside_generated_code(odd, models):
    plan = score(odd, models)._jdf.queryExecution().explainString(_mode(odd))
    assert "UDF" not in plan and "[codegen id" in plan
    assert "UDF" in score(odd, models, native=False)._jdf.queryExecution().explainString(_mode(odd))


def test_sql_text_runs_elsewhere(spark, odd, models):
    local = odd.withColumn("datetime", F.col("datetime").cast("string")).toPandas()
    fitted = score(odd, models, native=False).select("row", *PUBLISHED).toPandas().set_index("row").sort_index()
    db = duckdb.connect()
    db.register("odd_rows", local)
    for role, model in models.items():
        query = as_sql(compile_model(spark, model, role), "odd_rows", ["row"])
        there = db.sql(query).df().set_index("row").sort_index()
        for c in there.columns:
            assert (abs(there[c] - fitted[c]) < 1e-9).all(), (role, c)


def test_large_forests_stay_pipelines(table):
    deep = train_regressor(table, ["main_aqi", "temperature_2m", "hour", "city"], trees=12, depth=12)
    assert not fits(deep.stages[-1])
    assert "UDF" in score(table, {"regressor": deep})._jdf.queryExecution().explainString(_mode(table))


def test_one_class_and_few_inputs(spark, table):
    safe = table.withColumn(HAZARD, F.lit(0))
    alone = {"classifier": train_classifier(safe, ["main_aqi"], trees=2, depth=2)}
    native, fitted = score(table, alone), score(table, alone, native=False)
    assert native.select("hazard_class", "hazard_prob").distinct().collect() == fitted.select("hazard_class", "hazard_prob").distinct().collect()
    level = {"regressor": train_current_level(table, 3, 4)}
    assert score(table, level).select("datetime", "city", "aqi_3h").exceptAll(score(table, level, native=False).select("datetime", "city", "aqi_3h")).isEmpty()


def test_columns_of_the_frame_stay(spark, table, models):
    wide = table.withColumn("aqi_note", F.lit("kept"))
    model = compile_model(spark, models["regressor"], "regressor")
    out = apply_compiled(wide, model)
    assert out.columns == [*wide.columns, "aqi_3h"] and out.filter("aqi_note <> 'kept'").isEmpty()
    assert out.filter(F.col("aqi_3h").isNull()).isEmpty() and TARGET in out.columns
