"""Distributions stored by day against the same work over the readings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocast.operators import daily, drift
from aerocast.operators.ordered import percentiles

COLUMNS = ["x", "y", "z"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = []
    for i in range(3000):
        x = float(rng.normal(0, 10.0 ** rng.integers(-3, 4)))
        data.append((i % 12, x if i % 7 else None, float(i % 5) - 2, float("nan") if i % 3 else 7.25))
    frame = spark.createDataFrame(data, "d int, x double, y double, z double")
    at = F.timestamp_add("DAY", F.col("d"), F.lit("2024-02-25 05:00:00").cast("timestamp_ntz"))
    return frame.select(at.alias("datetime"), *COLUMNS)


@pytest.fixture(scope="module")
def root(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("days"))
    first = F.col("datetime") < F.lit("2024-03-02").cast("timestamp_ntz")
    # The second part lands twice, the first time with other values: a day is replaced as a whole.
    daily.write_days(rows.filter(first), COLUMNS, path)
    daily.write_days(rows.filter(~first).withColumn("x", F.col("x") * 3 + 1), COLUMNS, path)
    daily.write_days(rows.filter(~first), COLUMNS, path)
    return path


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bins", [1, 5, 30])
def test_baselines_and_drift(spark, rows, root, bins):
    early = F.col("datetime") < F.lit("2024-03-01").cast("timestamp_ntz")
    days = F.col("day") < F.lit("2024-03-01").cast("date")
    base = drift.baseline_stats(rows.filter(early), COLUMNS, bins)
    ours = daily.day_baseline(spark, root, bins, days)
    assert collected(ours) == collected(base.select(ours.columns))
    report = drift.drift_report(rows.filter(~early), base, columns=COLUMNS)
    assert collected(daily.day_drift(spark, root, base, ~days)) == collected(report)


def test_edges_in_the_middle_of_values(spark, rows, root):
    edges = spark.createDataFrame([("x", [-1.0, 0.0, 0.5, 3.0]), ("y", [-1.0, 1.0]), ("z", [8.0, 9.0])], "feature string, bins array<double>")
    want = drift.bin_counts(rows, edges, COLUMNS)
    assert collected(daily.day_counts(spark, root, edges)) == collected(want)


def test_percentiles_and_their_bounds(spark, rows, root):
    probs = {"least": 0.0, "low": 0.013, "mid": 0.5, "high": 0.97, "most": 1.0}
    want = {(r["feature"], n): r[n] for r in percentiles(rows, COLUMNS, probs).collect() for n in probs}
    exact = {(r["feature"], r["name"]): r["value"] for r in daily.day_percentiles(spark, root, probs).collect()}
    assert exact == pytest.approx(want)
    near = daily.day_percentiles(spark, root, probs, exact=False).collect()
    assert len(near) == len(want)
    for r in near:
        true = want[r["feature"], r["name"]]
        assert r["low"] <= true <= r["high"]
        if r["feature"] == "z":
            assert r["low"] == r["high"] == 7.25


def test_other_days_are_not_read(spark, root):
    days = F.col("day") == F.lit("2024-02-27").cast("date")
    files = daily.read_histogram(spark, root, days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in files
    assert "day=" in "".join(spark.read.parquet(f"{root}/histogram").filter(days).inputFiles())
