"""Exact order statistics against NumPy and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocast.operators.ordered import area_under_curve, order_bucket, percentiles, time_percentile
from aerocast.operators.sampling import balanced_sample, sample_key, sample_rows


def test_bucket_never_decreases(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 2000), rng.normal(0, 1e12, 500), [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308]])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("b", order_bucket(F.col("v")))
    got = sorted((r["v"], r["b"]) for r in rows.collect())
    buckets = [b for _, b in got]
    assert buckets == sorted(buckets)
    assert len(set(buckets)) > 1500


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    frames = {
        "skewed": np.concatenate([rng.exponential(3, 900), [1e9]]),
        "signed": np.round(rng.normal(0, 5, 901), 1),
        "copies": np.where(rng.random(901) < 0.6, 0.0, rng.uniform(0, 9, 901)),
    }
    rows = list(zip(["x"] * 901, *[list(map(float, v)) for v in frames.values()]))
    rows += [("y", 1.0, 2.0, 3.0), ("y", 2.0, 4.0, 3.0), ("z", None, float("nan"), 7.0)]
    df = spark.createDataFrame(rows, "k string, skewed double, signed double, copies double").repartition(6)
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "p80": 0.8, "hi": 1.0}
    got = {(r["k"], r["feature"]): r for r in percentiles(df, list(frames), probs, ["k"]).collect()}
    for name, values in frames.items():
        for label, p in probs.items():
            assert got[("x", name)][label] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert got[("y", "skewed")]["mid"] == 1.5 and got[("y", "signed")]["q1"] == 2.5
    assert got[("z", "copies")]["mid"] == 7.0 and ("z", "skewed") not in got and ("z", "signed") not in got


def test_time_percentile(spark):
    df = spark.range(11).selectExpr("timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS datetime")
    base = 1704067200 * 1_000_000
    assert time_percentile(df, 0.8).first()[0] == base + 8 * 3_600_000_000
    assert time_percentile(df, 0.25).first()[0] == base + 2.5 * 3_600_000_000


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_area_under_curve(spark):
    rng = np.random.default_rng(3)
    pairs = [(float(np.round(rng.random(), 2)), int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame([("a", s, y) for s, y in pairs] + [("b", 0.5, 1)], "k string, s double, y int").repartition(4)
    by = {r["k"]: r["roc_auc"] for r in area_under_curve(df, "y", "s", ["k"]).collect()}
    assert by["a"] == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert by["b"] is None
    whole = area_under_curve(df, "y", "s").first()["roc_auc"]
    assert whole == pytest.approx(brute_auc(pairs + [(0.5, 1)]), abs=1e-12)


def labelled(spark, n, rare):
    at = "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS datetime"
    return spark.range(n).selectExpr("'a' AS city", at, f"CAST(id < {rare} AS INT) AS y")


def test_balanced_sample_takes_the_smallest_hashes(spark):
    rows = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS city", "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id % 7 AS INT)) AS datetime",
        "CASE WHEN id % 10 = 0 THEN 'rare' WHEN id % 10 = 1 THEN NULL ELSE 'usual' END AS y", "id",
    )
    hashed = rows.filter("y IS NOT NULL").withColumn("k", sample_key())
    want = {r["id"] for r in hashed.selectExpr("*", "row_number() OVER (PARTITION BY y ORDER BY k) AS n").filter("n <= 300").collect()}
    for most in (100_000, 3, 0):
        got = balanced_sample(rows, "y", most=most)
        assert got.columns == rows.columns and {r["id"] for r in got.collect()} == want
    assert balanced_sample(rows.filter("y IS NULL"), "y").count() == 0


def test_balanced_sample_cuts_repeated_rows(spark):
    same = spark.range(40).selectExpr("'a' AS city", "timestamp_ntz '2024-01-01 00:00:00' AS datetime", "IF(id < 11, 0, 1) AS y", "id")
    got = balanced_sample(same, "y", most=2)
    assert got.groupBy("y").count().orderBy("y").collect() == [(0, 11), (1, 11)]


def test_balanced_sample_is_even_and_repeatable(spark):
    df = labelled(spark, 3000, 170)
    one = balanced_sample(df, "y")
    counts = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    assert counts == {0: 170, 1: 170}
    two = balanced_sample(df.repartition(7), "y")
    assert one.exceptAll(two).isEmpty()


def test_sample_is_repeatable_and_bounded(spark):
    df = labelled(spark, 500, 10)
    one, two = sample_rows(df, 50), sample_rows(df.repartition(9), 50)
    assert one.count() == 50 and one.exceptAll(two).isEmpty()
    assert not one.exceptAll(sample_rows(df, 50, seed=7)).isEmpty()
    assert sample_rows(df, 5000).count() == 500
