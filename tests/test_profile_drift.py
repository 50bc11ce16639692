"""Profiles, histograms and drift against NumPy and hand-computed values."""

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerocast.contract import ContractError
from aerocast.operators import drift, metrics, profile


def column(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double").repartition(3)


VECTORS = [
    [1, 2, 3, 4, 5],
    [3, 3, 3],
    [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7],
    [-5, 0, 5, 5, 5, 10],
    [1.0, 1.8, 2.6, 3.4, 4.2, 5.0],
    list(np.round(np.random.default_rng(1).normal(0, 10, 500), 2)),
]


@pytest.mark.parametrize("values", VECTORS)
@pytest.mark.parametrize("bins", [3, 5, 30])
def test_histogram_matches_numpy(spark, values, bins):
    counts, edges = np.histogram(values, bins=bins)
    got = drift.equal_width_histogram(column(spark, [*values, None]), ["x"], bins).orderBy("bin").collect()
    assert [r["n"] for r in got] == list(counts)
    assert [r["lo"] for r in got] + [got[-1]["hi"]] == list(edges)
    assert sum(r["frac"] for r in got) == pytest.approx(1.0)


def test_given_edges_drop_outside_values(spark):
    edges = spark.createDataFrame([("x", [0.0, 1.0, 2.0])], "feature string, bins array<double>")
    got = drift.binned_counts(column(spark, [-1, 0, 0.5, 1, 2, 2.1]), edges).orderBy("bin").collect()
    assert [(r["n"], r["frac"]) for r in got] == [(2, 0.5), (2, 0.5)]


def test_baseline_skips_text_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, "a", None), (2.0, "b", None)], "x double, city string, empty double")
    stats = drift.baseline_stats(df, ["x", "city", "empty", "absent"], 2).collect()
    assert [(r["feature"], r["bins"], r["ref"]) for r in stats] == [("x", [1.0, 1.5, 2.0], [0.5, 0.5])]


def numpy_psi(ref, cur):
    ref, cur = np.asarray(ref), np.asarray(cur)
    return np.sum((ref - cur) * np.log((ref + 1e-6) / (cur + 1e-6)))


def test_scores(spark):
    baseline = spark.createDataFrame([("x", [0.0, 1.0, 2.0, 3.0], [0.5, 0.3, 0.2])], "feature string, bins array<double>, ref array<double>")
    row = drift.drift_scores(column(spark, [0.5, 1.5, 1.6, 2.5]), baseline).first()
    assert row["psi"] == pytest.approx(numpy_psi([0.5, 0.3, 0.2], [0.25, 0.5, 0.25]))
    assert row["ks"] == pytest.approx(0.25)


def test_no_drift_against_itself_and_none_in_range(spark):
    df = column(spark, VECTORS[-1])
    row = drift.drift_report(df, drift.baseline_stats(df, ["x"])).first()
    assert row["psi"] == pytest.approx(0, abs=1e-12) and row["ks"] == pytest.approx(0) and not row["drifted"]
    far = drift.drift_report(column(spark, [999]), drift.baseline_stats(df, ["x"])).first()
    assert far["ks"] == 0.0 and far["drifted"]


def test_check_drift(spark):
    df = column(spark, VECTORS[-1])
    baseline = drift.baseline_stats(df, ["x"])
    drift.check_drift(df, baseline)
    with pytest.raises(drift.DriftDetected, match="x"):
        drift.check_drift(df.withColumn("x", F.col("x") + 15), baseline)
    with pytest.raises(ContractError, match="missing"):
        drift.check_drift(df.withColumnRenamed("x", "z"), baseline)


def test_describe_matches_pandas(spark):
    values = [*VECTORS[-1], None, None]
    got = profile.describe(column(spark, values), ["x"]).first()
    want = pd.Series(values, dtype=float).describe()
    pairs = {"count": "count", "mean": "mean", "std": "std", "min": "min", "q1": "25%", "median": "50%", "q3": "75%", "max": "max"}
    for ours, theirs in pairs.items():
        assert got[ours] == pytest.approx(want[theirs])


HOURLY = [("a", datetime(2024, 1, 1, 0), 1.0), ("a", datetime(2024, 1, 1, 2), 3.0), ("a", datetime(2024, 1, 4, 0), 5.0), ("b", datetime(2024, 1, 1, 0), 2.0)]
HOURLY_SCHEMA = "city string, datetime timestamp_ntz, main_aqi double"


def test_gaps_and_daily_means(spark):
    df = spark.createDataFrame(HOURLY, HOURLY_SCHEMA)
    assert {r["city"]: r["missing_hours"] for r in profile.missing_hours(df).collect()} == {"a": 70, "b": 0}
    stamps = profile.missing_stamps(df)
    assert stamps.count() == 70 and stamps.filter("city = 'b'").isEmpty()
    days = {r["day"]: r["main_aqi_mean"] for r in profile.daily_mean(df, ["main_aqi"]).filter("city = 'a'").collect()}
    assert days == {date(2024, 1, 1): 2.0, date(2024, 1, 2): None, date(2024, 1, 3): None, date(2024, 1, 4): 5.0}


def test_missing_ranges(spark):
    """Gaps within a block, over block borders and over years; readings off the grid, one of them the last."""
    first = datetime(2020, 1, 30, 22, 15)
    at = [0, 1, 5, 700, 719, 720, 721, 1500, 1502, 40_000, 40_001, 1]
    rows = [("a", first + timedelta(hours=h), 1.0) for h in at] + [("b", first, 1.0), (None, first, 1.0), ("a", None, 1.0)]
    rows += [("a", first + timedelta(hours=3, minutes=1), 1.0), ("a", first + timedelta(hours=40_005, minutes=30), 1.0)]
    df = spark.createDataFrame(rows, HOURLY_SCHEMA)
    held = sorted({first + timedelta(hours=h) for h in at}) + [first + timedelta(hours=40_006)]
    want = {(a + timedelta(hours=1), b - timedelta(hours=1)) for a, b in zip(held, held[1:]) if b - a > timedelta(hours=1)}
    got = profile.missing_ranges(df).collect()
    assert {(r.gap_start, r.gap_end) for r in got} == want and len(got) == len(want)
    assert all(r.hours == (r.gap_end - r.gap_start) / timedelta(hours=1) + 1 for r in got)
    stamps = [r.datetime for r in profile.missing_stamps(df).collect()]
    assert len(stamps) == len(set(stamps)) == sum(r.hours for r in got) == profile.missing_hours(df).filter("city = 'a'").first()["missing_hours"]
    assert not set(stamps) & set(held[:-1])


def test_missing_hours_ignores_stamps_off_the_grid(spark):
    df = spark.createDataFrame(HOURLY[:3] + [("a", datetime(2024, 1, 1, 1, 30), 1.0)], HOURLY_SCHEMA)
    assert profile.missing_hours(df).first()["missing_hours"] == 70 == profile.missing_stamps(df).count()


def test_profile_counts(spark):
    rows = [("a", 1.0, None), ("a", 1.0, None), ("b", 2.0, None)]
    df = spark.createDataFrame(rows, "city string, x double, gone double")
    nulls = {r["column"]: (r["n_null"], r["null_share"]) for r in profile.null_profile(df).collect()}
    assert nulls == {"gone": (3, 1.0), "city": (0, 0.0), "x": (0, 0.0)}
    dups = {r["scope"]: r["duplicates"] for r in profile.duplicate_counts(df, ["x"]).collect()}
    assert dups == {"row": 1, "key": 1}
    assert [r["column"] for r in profile.single_valued_columns(df).collect()] == ["gone"]
    shares = {r["city"]: r["share"] for r in profile.value_shares(df, "city").collect()}
    assert shares == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}


def test_conflicting_labels(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1)], "f int, y int")
    assert profile.conflicting_labels(df, ["f"], "y").first()["n_conflicts"] == 2


def test_correlation_skips_null_pairs(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"a": rng.normal(size=100), "b": rng.normal(size=100)})
    frame.loc[::7, "b"] = np.nan
    df = spark.createDataFrame([(float(a), None if np.isnan(b) else float(b)) for a, b in frame.itertuples(index=False)], "a double, b double")
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(frame.corr().loc["a", "b"])
    assert got[("a", "a")] == pytest.approx(1.0)


def test_box_stats_match_numpy(spark):
    values = [*VECTORS[-1], 500.0, -500.0]
    df = column(spark, values).withColumn("city", F.lit("a"))
    got = profile.box_stats(df, ["x"]).first()
    q1, mid, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (got["q1"], got["median"], got["q3"]) == pytest.approx((q1, mid, q3))
    assert (got["whisker_low"], got["whisker_high"]) == (min(inside), max(inside))
    assert got["n_outliers"] == len(values) - len(inside)


def test_regression_and_classification_metrics(spark):
    rows = [("a", 1.0, 1.5, 0, 0), ("a", 4.0, 3.0, 1, 0), ("a", 5.0, 5.0, 1, 1), ("b", 2.0, 2.0, 0, 0)]
    df = spark.createDataFrame(rows, "city string, y double, p double, h int, c int")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["mse"] == pytest.approx(0.3125) and row["rmse"] == pytest.approx(0.3125**0.5)
    assert row["mae"] == pytest.approx(0.375) and row["r2"] == pytest.approx(1 - 1.25 / 10)
    got = metrics.classification_metrics(df, "h", "c").first()
    assert (got["accuracy"], got["tn"], got["fp"], got["fn"], got["tp"]) == (0.75, 2, 0, 1, 1)
    assert got["f1"] == pytest.approx(2 / 3)
    by = {r["scope"]: r for r in metrics.metrics_by_city(df, "y", "p", "h", "c").collect()}
    assert by["(all)"]["n"] == 4 and by["b"]["f1"] == 0.0 and by["b"]["r2"] is None
    assert metrics.level_accuracy(df, "y", "p").first()[0] == pytest.approx(0.5)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert {r["y"]: r["weight"] for r in metrics.class_weights(df, "y").collect()} == {0: pytest.approx(4 / 6), 1: 2.0}
    assert {r["smallest"] for r in metrics.label_counts(df, "y").collect()} == {1}


def test_scoring_counters(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", None)], "city string, ok boolean")
    got = {r["scope"]: (r["total"], r["successful"], r["failed"]) for r in metrics.scoring_counters(df).collect()}
    assert got == {"(all)": (3, 1, 2), "a": (2, 1, 1), "b": (1, 0, 1)}
