"""Label rules, advice, time parsing."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerocast.functions import calendar as cal
from aerocast.functions import labels as lab
from aerocast.functions.advice import CALM_ADVICE, HAZARD_ADVICE, advice_record


def over(spark, values, *columns):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i int, v double")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_half_even_rounding_and_clipping(spark):
    v = F.col("v")
    got = over(spark, [0.2, 1.5, 2.5, 3.5, 4.5, 5.5, 9.0, None, float("nan")], lab.severity_bucket(v), lab.severity_label(v))
    good, moderate, sensitive, bad, worst = lab.SEVERITY_BY_LEVEL
    assert got == [
        (0, good),
        (1, moderate),
        (1, moderate),
        (3, bad),
        (3, bad),
        (3, worst),
        (3, worst),
        (2, "Unknown"),
        (2, "Unknown"),
    ]


def test_category_has_upper_bounds(spark):
    got = over(spark, [1.0, 1.01, 2.0, 3.0, 4.0, 4.01, None], lab.aqi_category(F.col("v")))
    assert [g[0] for g in got] == ["Good", "Fair", "Fair", "Moderate", "Poor", "Very Poor", "Unknown"]


def test_hazard_rules_keep_two_spellings(spark):
    v = F.col("v")
    got = over(spark, [3.99, 4.0], lab.hazard_flag(v), lab.hazard_text(v), lab.hazard_class_text(lab.hazard_flag(v)))
    assert got == [(0, "Safe / Moderate", "safe/moderate"), (1, "Hazardous", "hazardous")]


def test_bucket_labels(spark):
    got = over(spark, [0, 1, 2, 3, 4, None], lab.bucket_label(F.col("v")))
    assert [g[0] for g in got] == ["Good", "Moderate", "Unhealthy for sensitive groups", "Unhealthy", "Unknown", "Unknown"]


def test_trend_band(spark):
    got = over(spark, [3.1, 3.3, 2.7, None], lab.trend_note(F.col("v"), F.lit(3.0)))
    assert [g[0] for g in got] == [lab.TREND_SAME, lab.TREND_WORSE, lab.TREND_BETTER, None]


@pytest.mark.parametrize("level", [1.6, 3.99, 4.0, 4.9])
def test_advice_follows_the_hazard_text(spark, level):
    text = lab.hazard_text(F.col("v"))
    record = over(spark, [level], advice_record(F.col("v"), text, F.col("v") - 1, horizon=6))[0][0].asDict(recursive=True)
    source = HAZARD_ADVICE if level >= 4 else CALM_ADVICE
    assert record["actions_general"] == source["general"]
    assert record["actions_sensitive_groups"] == source["sensitive"]
    assert record["headline"] == source["headline"].format(h=6)
    assert record["summary"] == f"{source['summary']} {lab.TREND_WORSE}"
    assert record["based_on"]["current_aqi"] == pytest.approx(level - 1)
    assert record["based_on"]["horizon_hours"] == 6 and record["based_on"]["recommender_model"] is None


def test_advice_for_all_levels_without_current(spark):
    recs = over(spark, [1, 2, 3, 4, 5], advice_record(F.col("v"), F.lit("Safe")))
    assert [r[0]["severity_bucket"] for r in recs] == lab.SEVERITY_BY_LEVEL
    assert all("expected" not in r[0]["summary"] for r in recs)


def test_a_chosen_bucket_beats_the_rule(spark):
    for bucket, words in enumerate(lab.SEVERITY_BY_BUCKET):
        record = over(spark, [4.4], advice_record(F.col("v"), F.lit("calm"), None, F.lit(bucket), "stored/tree"))[0][0]
        assert (record["severity_bucket"], record["based_on"]["recommender_model"]) == (words, "stored/tree")


def test_nan_is_not_hazardous(spark):
    got = over(spark, [float("nan"), float("inf"), None], lab.hazard_flag(F.col("v")), lab.hazard_text(F.col("v")))
    assert got == [(0, lab.HAZARD_TEXT[1]), (1, lab.HAZARD_TEXT[0]), (None, lab.HAZARD_TEXT[1])]


def test_missing_hazard_text_counts_as_calm(spark):
    rec = over(spark, [2.0], advice_record(F.col("v"), F.lit(None).cast("string")))[0][0]
    assert "acceptable" in rec["headline"]


def test_time_spellings(spark):
    cases = {
        "2024-01-02 03:04:05": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02": datetime(2024, 1, 2),
        "2024-01-02T03:04": datetime(2024, 1, 2, 3, 4),
        "2024-01-02T03:04:05.123+05:00": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
        "02/01/2024 3:04": datetime(2024, 1, 2, 3, 4),
        "13/01/2024": datetime(2024, 1, 13),
        "5-1-2024 23:00:00": datetime(2024, 1, 5, 23),
        "5.1.2024 23:00": datetime(2024, 1, 5, 23),
        " 2024-01-02 03:00 ": datetime(2024, 1, 2, 3),
        "31/02/2024": None,
        "soon": None,
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r["t"]: r["p"] for r in df.select("t", cal.parse_local_time(F.col("t")).alias("p")).collect()}
    assert got == cases


def test_epoch_and_display(spark):
    df = spark.createDataFrame([(1704067200,), (4102444800,)], "s bigint")
    utc, local = cal.epoch_to_utc(F.col("s")), cal.epoch_to_local(F.col("s"))
    rows = df.select(utc, local, cal.forecast_time(local), cal.display_time(local)).collect()
    assert tuple(rows[0]) == (
        datetime(2024, 1, 1),
        datetime(2024, 1, 1, 5),
        datetime(2024, 1, 1, 8),
        "01 Jan 2024, 05:00 AM PKT",
    )
    assert rows[1][0] == datetime(2100, 1, 1)


def test_monday_is_zero(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 7),), (datetime(2024, 1, 6, 7),)], "t timestamp_ntz")
    rows = df.select(*cal.calendar_columns(F.col("t")).values()).collect()
    assert [tuple(r) for r in rows] == [(7, 0, 1, 0), (7, 5, 1, 1)]
