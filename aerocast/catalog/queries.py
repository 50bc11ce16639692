"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.catalog.views import (
    BASELINE_UNTIL,
    COARSE,
    COARSE_DEPTH,
    CUTOFF,
    DROPOUT_BELOW,
    MEASURED,
    STATIONS,
    coarse,
    dropout_readings,
    events,
    features,
    forecast,
    raw_readings,
    reading_columns,
    readings,
    station_readings,
)
from aerocast.contract import CITIES, ENGINEERED, FEATURES, HAZARD, TARGET, ContractError, feature_columns
from aerocast.functions import calendar as cal
from aerocast.functions import labels as lab
from aerocast.functions.advice import advice_record
from aerocast.models.registry import load_models, model_paths, promote, save_models, save_production
from aerocast.models.training import (
    fit_preprocessor,
    impute_values,
    score,
    train_all,
    train_classifier,
    train_current_level,
    train_recommender,
    train_regressor,
)
from aerocast.operators import checks, daily, drift, metrics, profile, sampling, splits
from aerocast.operators.ordered import area_under_curve, percentiles
from aerocast.operators.readings import (
    align_columns,
    before_cutoff,
    city_name,
    join_observations,
    numeric_measures,
    parse_datetime,
    standard_headers,
    supported_cities,
    trailing_days,
    union_sources,
    unsupported_cities,
    with_coordinates,
)
from aerocast.operators.scoring import cold_start_features, prediction_records, serving_columns
from aerocast.operators.series import (
    add_calendar,
    add_future_target,
    add_lags,
    add_rolling,
    build_features,
)
from aerocast.operators.series import forecast_features as build_forecast_features
from aerocast.plans.evaluate import evaluate
from aerocast.plans.quality import balanced_model_report, integrity_profile, run_checks
from aerocast.plans.serve import score_csv, served_rows
from aerocast.plans.training import evaluate_on_test, periods, training_run
from aerocast.session import materialise, scratch_path
from aerocast.sources import files, payloads, records
from aerocast.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TREES, DEPTH = 20, 8


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(column: Column | str) -> Column:
    """Rounded for comparison: engines add doubles in different orders."""
    return F.round(column, 6)


def rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-free time, whatever the zone of the session."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


ROLLED_OUT = [c for c in ENGINEERED if c.endswith("_mean")]

# --- Series ---------------------------------------------------------------


@query
def dedup_readings(spark, sf_dir):
    return readings(spark, sf_dir)


@query
def future_target(spark, sf_dir):
    return add_future_target(readings(spark, sf_dir))


@query
def future_target_dropouts(spark, sf_dir):
    return add_future_target(dropout_readings(spark, sf_dir))


@query
def lag_features(spark, sf_dir):
    return add_lags(readings(spark, sf_dir))


@query
def rolling_mean(spark, sf_dir):
    return rounded(add_rolling(readings(spark, sf_dir)), ROLLED_OUT)


@query
def calendar_features(spark, sf_dir):
    return add_calendar(readings(spark, sf_dir))


@query
def forecast_features(spark, sf_dir):
    return rounded(features(spark, sf_dir), ROLLED_OUT)


@query
def forecast_features_dropouts(spark, sf_dir):
    return rounded(build_forecast_features(dropout_readings(spark, sf_dir), block="1d"), ROLLED_OUT)


@query
def features_from_targets(spark, sf_dir):
    return rounded(build_features(add_future_target(readings(spark, sf_dir))), ROLLED_OUT)


# --- Splits and filters ----------------------------------------------------


@query
def time_split(spark, sf_dir):
    return splits.mark_split(features(spark, sf_dir), CUTOFF).select("city", "datetime", TARGET, "split")


@query
def quantile_split(spark, sf_dir):
    # Read for the percentile and for the marks.
    table = materialise(readings(spark, sf_dir).select("city", "datetime"), "readings")
    return splits.mark_quantile_split(table).select("city", "datetime", "split")


@query
def split_periods(spark, sf_dir):
    return profile.split_periods(splits.mark_split(features(spark, sf_dir), CUTOFF))


@query
def cutoff_filter(spark, sf_dir):
    return before_cutoff(raw_readings(spark, sf_dir), CUTOFF)


@query
def last_7_days(spark, sf_dir):
    return trailing_days(readings(spark, sf_dir), 7)


@query
def city_series(spark, sf_dir):
    return readings(spark, sf_dir).filter(F.col("city") == "error")


@query
def parsed_times(spark, sf_dir):
    """Times written in five ways, one of them unreadable."""
    kind, ts = F.col("event_type"), F.col("ts")
    text = (
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "error", F.date_format(ts, "dd/MM/yyyy HH:mm"))
        .when(kind == "purchase", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")))
        .when(kind == "signup", F.date_format(ts, "d-M-yyyy H:mm:ss"))
        .otherwise(F.lit("not recorded"))
    )
    return parse_datetime(events(spark, sf_dir).select("event_id", text.alias("datetime")))


@query
def coerced_numbers(spark, sf_dir):
    """Measures stored as text, some of them unreadable."""
    text = F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    raw = events(spark, sf_dir).select("event_id", text.alias("value"), F.col("user_id").alias("user id"))
    return numeric_measures(raw, ("event_id",)).withColumnRenamed("user id", "user_id")


@query
def standardised_headers(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    dotted = raw.toDF(*[f" {c.replace('components_', 'components.')} " for c in raw.columns])
    return standard_headers(dotted)


@query
def aligned_columns(spark, sf_dir):
    """Readings brought to the columns of the feature contract's raw part: extras dropped, order fixed."""
    return align_columns(raw_readings(spark, sf_dir), ["datetime", "components_pm10", "main_aqi"], "readings")


# --- Joins and sets --------------------------------------------------------


@query
def city_lookup(spark, sf_dir):
    return with_coordinates(station_readings(spark, sf_dir)).select("city_key", "datetime", "main_aqi", "lat", "lon")


@query
def supported_city_filter(spark, sf_dir):
    kept = supported_cities(station_readings(spark, sf_dir))
    return kept.select(city_name(F.col("city")).alias("city"), "datetime", "main_aqi")


@query
def unsupported_city_rows(spark, sf_dir):
    return unsupported_cities(station_readings(spark, sf_dir))


@query
def latest_observation_join(spark, sf_dir):
    """Pollutants as recorded, weather recorded half an hour later."""
    base = readings(spark, sf_dir)
    weather = base.select("city", F.expr("datetime + INTERVAL 30 MINUTES").alias("datetime"), "components_pm10")
    return join_observations(base.select("city", "datetime", "main_aqi", "components_pm2_5"), weather)


@query
def served_observations(spark, sf_dir):
    """Model inputs of the newest pollutants and weather of each supported station, from all observations."""
    base = station_readings(spark, sf_dir)
    pollutants = base.select("city", F.col("datetime").alias("observed_at_local"), *MEASURED)
    weather = base.select("city", F.expr("datetime - INTERVAL 1 HOUR").alias("datetime"), F.col("components_pm10").alias("precipitation"))
    rows = served_rows(pollutants, weather)
    return rows.select("city", "datetime", "observed_at_local", *MEASURED, "precipitation", "hour", "main_aqi_lag_3")


@query
def served_records(spark, sf_dir):
    """Prediction records of the served rows, the level as its own forecast: once by rule, once by a stored model's bucket."""
    base = station_readings(spark, sf_dir)
    pollutants = base.select("city", F.col("datetime").alias("observed_at_local"), *MEASURED)
    rows = served_rows(pollutants, base.select("city", "datetime", F.col("components_pm10").alias("precipitation")))
    by_rule = rows.withColumn("aqi_3h", F.col("main_aqi"))
    by_model = by_rule.withColumn("severity_model", F.lit(0))
    out = None
    for source, frame in (("rule", by_rule), ("model", by_model)):
        record = prediction_records(frame, "stored/tree", observed="observed_at_local")
        flat = record.select(
            F.lit(source).alias("source"),
            "city",
            "prediction.hazard_label",
            "realtime.predicted_for_local",
            "recommendations.severity_bucket",
            "recommendations.based_on.recommender_model",
        )
        out = flat if out is None else out.unionByName(flat)
    return out


@query
def union_of_sources(spark, sf_dir):
    base = readings(spark, sf_dir)
    at = F.lit(CUTOFF).cast("timestamp_ntz")
    newer = base.filter(F.col("datetime") > at).select(*reversed(base.columns))
    return union_sources(base, newer)


@query
def distinct_cities(spark, sf_dir):
    return raw_readings(spark, sf_dir).select("city").distinct()


# --- Profiles --------------------------------------------------------------


def _levels(spark, sf_dir):
    return readings(spark, sf_dir).withColumn("level", lab.rounded_level(F.col("main_aqi")))


@query
def city_counts(spark, sf_dir):
    return profile.value_counts(raw_readings(spark, sf_dir), "city")


@query
def level_counts(spark, sf_dir):
    return profile.value_counts(_levels(spark, sf_dir), "level")


@query
def level_share(spark, sf_dir):
    return rounded(profile.value_shares(_levels(spark, sf_dir), "level"), ["share"])


@query
def level_share_by_city(spark, sf_dir):
    return rounded(profile.value_shares(_levels(spark, sf_dir), "level", ["city"]), ["share"])


@query
def null_profile(spark, sf_dir):
    return rounded(profile.null_profile(dropout_readings(spark, sf_dir)), ["null_share"])


@query
def duplicate_counts(spark, sf_dir):
    return profile.duplicate_counts(raw_readings(spark, sf_dir).drop("event_id"))


@query
def describe(spark, sf_dir):
    out = profile.describe(dropout_readings(spark, sf_dir), MEASURED)
    return rounded(out, ["mean", "std", "min", "q1", "median", "q3", "max"])


@query
def box_stats(spark, sf_dir):
    out = profile.box_stats(readings(spark, sf_dir), ["components_pm2_5", "components_pm10"])
    return rounded(out, ["q1", "median", "q3", "whisker_low", "whisker_high"])


@query
def daily_mean_filled(spark, sf_dir):
    """One series per user and kind of event: most have days without readings."""
    series = F.concat_ws(":", F.col("event_type"), F.col("user_id").cast("string")).alias("series")
    rows = events(spark, sf_dir).select(series, *reading_columns())
    out = profile.daily_mean(rows, ["main_aqi", "components_pm2_5"], "series")
    return rounded(out, ["main_aqi_mean", "components_pm2_5_mean"])


@query
def missing_hours(spark, sf_dir):
    return profile.missing_hours(readings(spark, sf_dir))


@query
def missing_ranges(spark, sf_dir):
    return profile.missing_ranges(readings(spark, sf_dir))


@query
def missing_ranges_by_series(spark, sf_dir):
    """Gaps of the many short series of an event type and a user, whose readings are far apart."""
    series = F.concat_ws(":", F.col("event_type"), F.col("user_id").cast("string")).alias("city")
    return profile.missing_ranges(events(spark, sf_dir).select(series, *[c for c in reading_columns()[1:2]]))


@query
def missing_stamps(spark, sf_dir):
    return profile.missing_stamps(readings(spark, sf_dir))


@query
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(dropout_readings(spark, sf_dir), MEASURED), ["corr"])


@query
def imputation_values(spark, sf_dir):
    """Median per measure, as the imputer uses it."""
    return rounded(percentiles(dropout_readings(spark, sf_dir), MEASURED, {"median": 0.5}), ["median"])


# --- Histograms and drift --------------------------------------------------


@query
def histogram_equal_width(spark, sf_dir):
    out = drift.equal_width_histogram(readings(spark, sf_dir), MEASURED, 30)
    return rounded(out, ["lo", "hi", "frac"])


def _sides(spark, sf_dir):
    base = readings(spark, sf_dir)
    at = F.lit(BASELINE_UNTIL).cast("timestamp_ntz")
    return base.filter(F.col("datetime") <= at), base.filter(F.col("datetime") > at)


@query
def histogram_given_edges(spark, sf_dir):
    before, after = _sides(spark, sf_dir)
    edges = drift.equal_width_edges(before, MEASURED, 5)
    return rounded(drift.binned_counts(after, edges, MEASURED), ["lo", "hi", "frac"])


@query
def drift_report(spark, sf_dir):
    before, after = _sides(spark, sf_dir)
    baseline = drift.baseline_stats(before, MEASURED)
    return rounded(drift.drift_report(after, baseline, columns=MEASURED), ["psi", "ks"])


@query
def drift_report_shifted(spark, sf_dir):
    """The same report where one column really moved."""
    before, after = _sides(spark, sf_dir)
    moved = after.withColumn("components_pm10", F.col("components_pm10") / 3)
    baseline = drift.baseline_stats(before, MEASURED)
    return rounded(drift.drift_report(moved, baseline, columns=MEASURED), ["psi", "ks"])


def _days(spark, sf_dir, rows: DataFrame) -> str:
    """Distributions by day of ``rows``, stored day by day as a daily job would."""
    root, table = scratch_path(spark, "by-day"), materialise(rows, "readings")
    until = F.lit(BASELINE_UNTIL).cast("timestamp_ntz")
    daily.write_days(table.filter(F.col("datetime") <= until), MEASURED, root)
    daily.write_days(table.filter(F.col("datetime") > until), MEASURED, root)
    return root


BASELINE_DAY = BASELINE_UNTIL[:10]


@query
def drift_from_days(spark, sf_dir):
    """The drift report from stored distributions of days, without the readings."""
    root = _days(spark, sf_dir, readings(spark, sf_dir))
    baseline = materialise(daily.day_baseline(spark, root, 5, F.col("day") <= F.lit(BASELINE_DAY).cast("date")), "baseline")
    return rounded(daily.day_drift(spark, root, baseline, F.col("day") > F.lit(BASELINE_DAY).cast("date")), ["psi", "ks"])


@query
def histogram_from_days(spark, sf_dir):
    root = _days(spark, sf_dir, readings(spark, sf_dir))
    edges = daily.day_edges(spark, root, 30)
    counted = daily.day_counts(spark, root, edges)
    return rounded(drift.bins_of(counted), ["lo", "hi", "frac"])


@query
def percentiles_from_days(spark, sf_dir):
    """Exact percentiles of all days, and whether the bounds known without any values hold them."""
    root = _days(spark, sf_dir, dropout_readings(spark, sf_dir))
    probs = {"p01": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    near = daily.day_percentiles(spark, root, probs, exact=False).select("feature", "name", "low", "high")
    both = daily.day_percentiles(spark, root, probs).select("feature", "name", "value").join(near, ["feature", "name"])
    return both.select("feature", "name", r6("value").alias("value"), F.col("value").between(F.col("low"), F.col("high")).alias("within_bounds"))


# --- Metrics ---------------------------------------------------------------


@query
def regression_metrics(spark, sf_dir):
    out = metrics.regression_metrics(forecast(spark, sf_dir), TARGET, "aqi_3h")
    return rounded(out, ["mse", "rmse", "mae", "r2"])


@query
def classification_metrics(spark, sf_dir):
    out = metrics.classification_metrics(forecast(spark, sf_dir), HAZARD, "hazard_class")
    return rounded(out, ["accuracy", "f1"])


@query
def roc_auc(spark, sf_dir):
    return rounded(area_under_curve(forecast(spark, sf_dir), HAZARD, "hazard_prob"), ["roc_auc"])


@query
def roc_auc_by_city(spark, sf_dir):
    return rounded(area_under_curve(forecast(spark, sf_dir), HAZARD, "hazard_prob", ["city"]), ["roc_auc"])


@query
def metrics_by_city(spark, sf_dir):
    out = metrics.metrics_by_city(forecast(spark, sf_dir), TARGET, "aqi_3h", HAZARD, "hazard_class")
    return rounded(out, ["mse", "rmse", "mae", "r2", "accuracy", "f1"])


@query
def level_accuracy(spark, sf_dir):
    return rounded(metrics.level_accuracy(forecast(spark, sf_dir), TARGET, "aqi_3h"), ["level_accuracy"])


@query
def severity_accuracy(spark, sf_dir):
    out = metrics.severity_accuracy(forecast(spark, sf_dir), TARGET, F.col("severity_model"))
    return rounded(out, ["severity_accuracy"])


@query
def label_counts(spark, sf_dir):
    return metrics.label_counts(features(spark, sf_dir), HAZARD)


@query
def class_weights(spark, sf_dir):
    return rounded(metrics.class_weights(features(spark, sf_dir), HAZARD), ["weight"])


@query
def scoring_counters(spark, sf_dir):
    log = raw_readings(spark, sf_dir).select("city", (F.col("components_pm2_5") >= 1).alias("ok"))
    return metrics.scoring_counters(log)


# --- Labels and advice -----------------------------------------------------


def _labelled(spark, sf_dir, **rules: Column) -> DataFrame:
    """Label rules on every reading, missing levels included."""
    return dropout_readings(spark, sf_dir).select("city", "datetime", *[c.alias(n) for n, c in rules.items()])


LEVEL = "main_aqi"


@query
def hazard_label(spark, sf_dir):
    """The 0/1 label and both spellings: by level and by class."""
    flag = lab.hazard_flag(F.col(LEVEL))
    words = lab.hazard_text(F.col(LEVEL))
    return _labelled(spark, sf_dir, hazard=flag, by_level=words, by_class=lab.hazard_class_text(flag))


@query
def severity_bucket(spark, sf_dir):
    bucket = lab.severity_bucket(F.col(LEVEL))
    return _labelled(spark, sf_dir, severity_bucket=bucket, bucket_label=lab.bucket_label(bucket))


@query
def severity_label(spark, sf_dir):
    return _labelled(spark, sf_dir, severity_label=lab.severity_label(F.col(LEVEL)))


@query
def aqi_category(spark, sf_dir):
    return _labelled(spark, sf_dir, aqi_category=lab.aqi_category(F.col(LEVEL)))


@query
def half_level_labels(spark, sf_dir):
    """Levels moved onto halves, where half-to-even rounding decides."""
    level = F.floor(F.col("main_aqi") * 2) / 2
    return readings(spark, sf_dir).select(
        "city",
        "datetime",
        level.alias("level"),
        lab.severity_bucket(level).alias("severity_bucket"),
        lab.severity_label(level).alias("severity_label"),
        lab.aqi_category(level).alias("aqi_category"),
    )


@query
def trend_note(spark, sf_dir):
    return features(spark, sf_dir).select(
        "city", "datetime", lab.trend_note(F.col(TARGET), F.col("main_aqi")).alias("trend_note")
    )


def _flat_advice(df: DataFrame, record: Column) -> DataFrame:
    opened = df.select("city", "datetime", record.alias("r"))
    return opened.select(
        "city",
        "datetime",
        F.col("r.severity_bucket").alias("severity_bucket"),
        F.col("r.headline").alias("headline"),
        F.col("r.summary").alias("summary"),
        F.array_join("r.actions_general", " | ").alias("actions_general"),
        F.array_join("r.actions_sensitive_groups", " | ").alias("actions_sensitive_groups"),
        F.col("r.based_on.horizon_hours").alias("horizon_hours"),
        F.col("r.based_on.predicted_aqi").alias("predicted_aqi"),
        F.col("r.based_on.current_aqi").alias("current_aqi"),
    )


@query
def recommendations(spark, sf_dir):
    """Advice for the known future level; the severity comes from the rule."""
    record = advice_record(F.col(TARGET), lab.hazard_text(F.col(TARGET)), F.col("main_aqi"))
    return _flat_advice(features(spark, sf_dir), record)


@query
def recommendations_from_bucket(spark, sf_dir):
    """Advice where a severity bucket is given."""
    record = advice_record(
        F.col("aqi_3h"), lab.hazard_text(F.col("aqi_3h")), None, F.col("severity_model"), "recommender"
    )
    return _flat_advice(forecast(spark, sf_dir), record)


@query
def observation_times(spark, sf_dir):
    """Epoch seconds to UTC and station time, forecast time, display text."""
    seconds = epoch_seconds(F.col("ts"))
    local = cal.epoch_to_local(seconds)
    return events(spark, sf_dir).select(
        "event_id",
        cal.epoch_to_utc(seconds).alias("observed_at_utc"),
        local.alias("observed_at_local"),
        cal.forecast_time(local).alias("predicted_for_local"),
        cal.display_time(local).alias("display"),
    )


@query
def cold_start_rows(spark, sf_dir):
    rows = station_readings(spark, sf_dir)
    patchy = rows.withColumn("components_pm10", F.when(F.col("components_pm10") >= 50, F.col("components_pm10")))
    built = cold_start_features(patchy)
    return built.select("datetime", *[c for c in FEATURES if c in built.columns])


# --- Checks ----------------------------------------------------------------


@query
def raw_checks(spark, sf_dir):
    return checks.raw_report(dropout_readings(spark, sf_dir))


@query
def feature_checks(spark, sf_dir):
    return checks.feature_report(features(spark, sf_dir))


@query
def integrity_report(spark, sf_dir):
    gaps = features(spark, sf_dir).withColumn("main_aqi", F.col("main_aqi") + F.col("components_pm10") / 50)
    return checks.integrity_report(gaps)


@query
def prediction_checks(spark, sf_dir):
    bold = forecast(spark, sf_dir).withColumn("prediction", F.col("aqi_3h") * 1.5 - 1)
    return checks.prediction_report(bold)


@query
def integrity_findings(spark, sf_dir):
    return integrity_profile(materialise(features(spark, sf_dir), "features"))


# --- Samples ---------------------------------------------------------------


@query
def hash_sample(spark, sf_dir):
    return sampling.sample_rows(readings(spark, sf_dir), 200)


@query
def balanced_sample(spark, sf_dir):
    table = materialise(features(spark, sf_dir), "features")
    return sampling.balanced_sample(table, HAZARD).select("city", "datetime", HAZARD)


@query
def earliest_rows(spark, sf_dir):
    return sampling.first_rows(readings(spark, sf_dir), 50)


# --- Payloads --------------------------------------------------------------


@query
def json_payload_fields(spark, sf_dir):
    """Pollutant payloads as the service sends them, one per event."""
    entry = F.struct(
        F.struct(F.least(F.lit(5.0), 1 + F.col("value") / 25).alias("aqi")).alias("main"),
        F.struct(F.col("value").alias("pm2_5"), (F.col("value") * 2).alias("co")).alias("components"),
        epoch_seconds(F.col("ts")).alias("dt"),
    )
    landed = events(spark, sf_dir).select("event_id", F.to_json(F.struct(F.array(entry).alias("list"))).alias("payload"))
    return payloads.pollutant_fields(landed).select(
        "event_id",
        "main_aqi",
        "components_pm2_5",
        "components_co",
        "components_no2",
        "observed_at_utc",
        "observed_at_local",
    )


def _weather_payloads(spark, sf_dir):
    """One column-oriented payload per city and day; a day has at most 24 readings."""
    hours = F.array_sort(F.collect_list(F.struct("datetime", "components_pm2_5", "components_pm10")))
    day = F.col("datetime").cast("date").alias("day")
    days = readings(spark, sf_dir).groupBy("city", day).agg(hours.alias("h"))
    series = F.struct(
        F.transform("h", lambda h: F.date_format(h["datetime"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.transform("h", lambda h: h["components_pm2_5"]).alias("temperature_2m"),
        F.transform("h", lambda h: h["components_pm10"]).alias("precipitation"),
    )
    return days.select("city", "day", F.to_json(F.struct(series.alias("hourly"))).alias("payload"))


WEATHER_OUT = ["city", "day", "datetime", "temperature_2m", "precipitation", "wind_speed_10m"]


@query
def weather_arrays_last(spark, sf_dir):
    return payloads.weather_last(_weather_payloads(spark, sf_dir)).select(*WEATHER_OUT)


@query
def weather_arrays_hours(spark, sf_dir):
    return payloads.weather_hours(_weather_payloads(spark, sf_dir)).select(*WEATHER_OUT)


# --- Files and records -----------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    path = files.write_csv(readings(spark, sf_dir), scratch_path(spark, "csv"))
    return files.read_readings_csv(spark, path)


@query
def layout_roundtrip(spark, sf_dir):
    """Readings written by month and range, read back through the layout."""
    path = files.write_by_month(readings(spark, sf_dir), scratch_path(spark, "layout"))
    return spark.read.parquet(path).drop("month_part")


@query
def city_files(spark, sf_dir):
    """All cities, stored with two kinds of headers, stacked and tagged."""
    base, root = materialise(readings(spark, sf_dir), "readings"), scratch_path(spark, "city-files")
    paths = {}
    for i, (kind, (city, _, _)) in enumerate(zip(sorted(STATIONS), CITIES)):
        dotted = i % 2 == 1
        part = base.filter(F.col("city") == kind).drop("city")
        part = part.withColumn("datetime", F.date_format("datetime", "dd/MM/yyyy HH:mm" if dotted else "yyyy-MM-dd HH:mm:ss"))
        if dotted:
            part = part.toDF(*[c.replace("components_", "components.") for c in part.columns])
        paths[city] = files.write_csv(part, f"{root}/{city}")
    return files.unify_training(spark, paths, CUTOFF).select("city", "datetime", *MEASURED)


@query
def json_stats_roundtrip(spark, sf_dir):
    """The stored drift baseline, read back and opened into bins."""
    path = records.save_baseline(readings(spark, sf_dir), MEASURED, scratch_path(spark, "baseline"))
    stored = records.load_baseline(spark, path)
    opened = stored.select("feature", "bins", F.posexplode("ref").alias("i", "frac"))
    return opened.select(
        "feature",
        (F.col("i") + 1).alias("bin"),
        r6(F.get("bins", F.col("i"))).alias("lo"),
        r6(F.get("bins", F.col("i") + 1)).alias("hi"),
        r6("frac").alias("frac"),
    )


@query
def latest_run(spark, sf_dir):
    """Two logged runs over the readings, the first with a duller forecast; the newer one is returned."""
    path = scratch_path(spark, "runs")
    scored = materialise(forecast(spark, sf_dir), "forecast")
    for at, run, frame in (
        ("2024-02-01T00:00:00Z", "first", scored.withColumn("aqi_3h", F.lit(3.0))),
        ("2024-02-02T00:00:00Z", "second", scored),
    ):
        found = evaluate(frame)
        records.log_run(
            spark, path, run, found["regression"], found["classification"], found["recommender"], {}, "persistence", at
        )
    out = records.latest_run(records.run_log(spark, path))
    out = rounded(out, ["reg_rmse", "reg_mae", "reg_r2", "clf_accuracy", "clf_f1", "clf_roc_auc", "rec_accuracy"])
    return out.drop("reg_model_path", "clf_model_path", "rec_model_path", "metadata_path")


# --- Models ----------------------------------------------------------------


def _train_val(spark, sf_dir):
    table = materialise(features(spark, sf_dir), "features")
    return splits.train_val(table, CUTOFF)


def _inputs(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("datetime", TARGET, HAZARD)]


# A fitted forest is not SQL, but what must hold for every published prediction is: these
# queries return the keys of all scored rows with rules that are worked out from real outputs.


@query
def prepared_inputs(spark, sf_dir):
    """Model inputs after filling, scaling and one-hot coding, for two measures and the city."""
    rows = materialise(dropout_readings(spark, sf_dir), "dropouts")
    fitted = fit_preprocessor(rows, ["main_aqi", "components_pm2_5", "city"])
    vector = vector_to_array(F.col("features"))
    parts = {"level_scaled": r6(vector[0]), "fine_dust_scaled": r6(vector[1])}
    parts |= {f"is_{kind}": vector[i + 2].cast("int") for i, kind in enumerate(sorted(STATIONS))}
    return fitted.transform(rows).select("city", "datetime", *[c.alias(n) for n, c in parts.items()])


@query
def rf_forecast(spark, sf_dir):
    train, val = _train_val(spark, sf_dir)
    models = {"regressor": train_regressor(train, _inputs(train), trees=TREES, depth=DEPTH)}
    low, high = train.agg(F.min(TARGET), F.max(TARGET)).first()
    scored = score(val, models)
    # Leaves hold means of training targets.
    return scored.select("city", "datetime", TARGET, F.col("aqi_3h").between(low - 1e-9, high + 1e-9).alias("within_training_range"))


@query
def rf_hazard(spark, sf_dir):
    train, val = _train_val(spark, sf_dir)
    scored = score(val, {"classifier": train_classifier(train, _inputs(train), trees=TREES, depth=DEPTH)})
    follows = F.col("hazard_class") == (F.col("hazard_prob") > 0.5).cast("int")
    return scored.select(
        "city", "datetime", HAZARD, F.col("hazard_prob").between(0, 1).alias("is_probability"),
        (follows | (F.col("hazard_prob") == 0.5)).alias("class_follows_probability"),
    )


@query
def tree_severity(spark, sf_dir):
    train, val = _train_val(spark, sf_dir)
    scored = score(val, {"recommender": train_recommender(train, _inputs(train), depth=DEPTH)})
    seen = [r[0] for r in train.select(lab.severity_bucket(F.col(TARGET))).distinct().collect()]  # four buckets at most
    return scored.select("city", "datetime", TARGET, F.col("severity_model").isin(seen).alias("is_trained_bucket"))


def _plain_trees(train: DataFrame) -> dict:
    """One tree per model, grown on the whole table and all inputs, so that SQL can grow the same."""
    prepared = fit_preprocessor(train, COARSE)
    plain = {"trees": 1, "depth": COARSE_DEPTH, "bootstrap": False}
    return {
        "regressor": train_regressor(train, COARSE, prepared, **plain),
        "classifier": train_classifier(train, COARSE, prepared, subset="all", **plain),
        "recommender": train_recommender(train, COARSE, prepared, depth=COARSE_DEPTH),
    }


def _predictions(scored: DataFrame, *more: str) -> DataFrame:
    return scored.select(
        "city", "datetime", *more, F.round("aqi_3h", 9).alias("aqi_3h"), "hazard_class", F.round("hazard_prob", 9).alias("hazard_prob"), "severity_model"
    )


@query
def tree_predictions(spark, sf_dir):
    """What the three models, trained on the earlier side, predict for each row of the later one."""
    train, val = _train_val(spark, sf_dir)
    return _predictions(score(coarse(val), _plain_trees(coarse(train))))


@query
def tree_predictions_by_pipeline(spark, sf_dir):
    """The same predictions from the fitted pipelines instead of the expressions compiled from them."""
    train, val = _train_val(spark, sf_dir)
    return _predictions(score(coarse(val), _plain_trees(coarse(train)), native=False))


@query
def predicted_records(spark, sf_dir):
    """Records of stored, promoted and reloaded models for the later side, with their predictions and advice."""
    train, val = _train_val(spark, sf_dir)
    root = scratch_path(spark, "plain-trees")
    promote(spark, save_models(spark, _plain_trees(coarse(train)), root, {}), root, {})
    scored = score(coarse(val), load_models(spark, root))
    records = prediction_records(scored, "stored/tree", carried=["datetime"])
    return records.select(
        "city",
        "datetime",
        F.round("prediction.aqi_3h", 9).alias("aqi_3h"),
        F.round("prediction.hazard_prob", 9).alias("hazard_prob"),
        F.col("prediction.hazard_label").alias("hazard_label"),
        F.col("recommendations.severity_bucket").alias("severity_bucket"),
        F.col("realtime.predicted_for_local").alias("predicted_for_local"),
    )


@query
def current_level_baseline(spark, sf_dir):
    """Counts of the later side, and how the metrics of the scored rows hang together."""
    marked = splits.mark_quantile_split(materialise(readings(spark, sf_dir), "readings"))
    train, val = marked.filter("split = 'train'"), marked.filter("split = 'val'")
    scored = materialise(score(val, {"regressor": train_current_level(train, TREES, DEPTH)}), "scored")
    found = metrics.regression_metrics(scored, "main_aqi", "aqi_3h")
    return found.select(
        "n",
        (F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) < 1e-9).alias("rmse_is_root_of_mse"),
        (F.col("mae") <= F.col("rmse")).alias("mae_is_below_rmse"),
        (F.col("r2") > 0).alias("beats_the_mean"),
    )


def _confusion_totals(spark, found: dict, extra: list[tuple[str, float]]) -> DataFrame:
    """Totals of a confusion matrix and its accuracy against the reported one."""
    (tn, fp), (fn, tp) = found["confusion_matrix"]
    total = tn + fp + fn + tp
    rows = [("safe", float(tn + fp)), ("hazardous", float(fn + tp)), ("rows", float(total))]
    rows += [("accuracy_from_counts", round((tn + tp) / total - found["accuracy"], 6)), *extra]
    rows += [("auc_is_a_share", float(0 <= found["roc_auc"] <= 1))]
    return spark.createDataFrame(rows, "metric string, value double")


@query
def holdout_eval(spark, sf_dir):
    """Store three models, load them again, evaluate them on the later side."""
    train, val = _train_val(spark, sf_dir)
    root = scratch_path(spark, "models")
    paths = save_models(spark, train_all(train, TREES, DEPTH), root, {"feature_columns": _inputs(train)})
    promote(spark, paths, root, {})
    scored = materialise(score(val, load_models(spark, root)), "scored")
    found = evaluate(scored)
    errors = scored.agg(F.avg((F.col(TARGET) - F.col("aqi_3h")) ** 2)).first()[0]
    same = float(abs(errors - found["regression"]["mse"]) < 1e-9)
    return _confusion_totals(spark, found["classification"], [("mse_recomputed", same)])


@query
def batch_scoring(spark, sf_dir):
    """Prediction records for the later side, from all three models, checked against their own parts."""
    train, val = _train_val(spark, sf_dir)
    scored = score(val, train_all(train, TREES, DEPTH))
    records = prediction_records(scored, "stored/tree", carried=["datetime", "severity_model"])
    based = F.col("recommendations.based_on")
    return records.select(
        "city",
        "datetime",
        F.col("realtime.current_aqi").alias("current_aqi"),
        F.col("realtime.predicted_for_local").alias("predicted_for_local"),
        (F.col("prediction.hazard_label") == lab.hazard_text(F.col("prediction.aqi_3h"))).alias("label_follows_level"),
        (F.col("recommendations.severity_bucket") == lab.bucket_label(F.col("severity_model"))).alias("bucket_follows_model"),
        (based["predicted_aqi"] == F.col("prediction.aqi_3h")).alias("advice_on_forecast"),
        based["recommender_model"].alias("recommender_model"),
    )


@query
def balanced_suite(spark, sf_dir):
    found = balanced_model_report(materialise(features(spark, sf_dir), "features"), TREES, DEPTH)
    return _confusion_totals(spark, found, [])


@query
def csv_scoring(spark, sf_dir):
    """Feature rows stored as CSV with raw city names, scored from the file; the inputs that the readings lack are 0."""
    train, val = _train_val(spark, sf_dir)
    lacking = [c for c in FEATURES if c not in val.columns]
    wide = val.withColumns({c: F.lit(0.0) for c in lacking}).withColumn("city", F.concat(F.lit(" "), F.upper("city")))
    path = files.write_csv(wide.select(*FEATURES), scratch_path(spark, "feature-csv"))
    models = train_all(train, TREES, DEPTH)
    records = score_csv(spark, path, models, "stored/tree")
    known = F.col("recommendations.based_on")
    return records.groupBy("city").agg(
        F.count("*").alias("n"),
        r6(F.sum(known["current_aqi"])).alias("current_aqi"),
        F.count_if(known["recommender_model"] != "stored/tree").alias("without_origin"),
        F.count_if(F.col("prediction.hazard_label") != lab.hazard_text(F.col("prediction.aqi_3h"))).alias("wrong_labels"),
    )


@query
def model_registry(spark, sf_dir):
    """Which models serving takes: before a promotion, after one, and after a newer one without a recommender."""
    train, _ = _train_val(spark, sf_dir)
    root = scratch_path(spark, "models")
    models = {r: m for r, m in train_all(train, 2, 2).items()}
    paths = save_models(spark, models, root, {"periods": periods(materialise(features(spark, sf_dir), "features"), CUTOFF)})
    steps = [("trained", model_paths(spark, root))]
    promote(spark, paths, root, {}, "run-1")
    steps.append(("promoted", model_paths(spark, root)))
    save_production(spark, {r: models[r] for r in ("regressor", "classifier")}, root, {})
    steps.append(("newer", model_paths(spark, root)))
    kept = records.read_record(spark, paths["metadata"])["periods"]
    rows = [(step, role, "/production/" in path) for step, found in steps for role, path in found.items()]
    listed = spark.createDataFrame(rows, "step string, role string, from_production boolean")
    sides = spark.createDataFrame([("periods", side, p["rows"] > 0) for side, p in kept.items()], listed.schema)
    return listed.unionByName(sides)


@query
def stored_metadata(spark, sf_dir):
    """Split periods written with a training run's record and read back."""
    found = periods(materialise(features(spark, sf_dir), "features"), CUTOFF)
    path = records.write_record(spark, {"periods": found}, scratch_path(spark, "metadata"))
    back = records.production_info(spark, path)["periods"]
    rows = [(side, p["start"], p["end"], p["rows"]) for side, p in back.items()]
    return spark.createDataFrame(rows, "split string, start string, end string, n long")


@query
def load_readings_first_row(spark, sf_dir):
    """Repeated readings with missing levels, landed and loaded: the first row of a key in the source stays."""
    raw = raw_readings(spark, sf_dir).withColumn("city", F.concat(F.upper("city"), F.lit(" ")))
    level = F.when(F.col("components_pm2_5") >= DROPOUT_BELOW, F.col("main_aqi"))
    source = scratch_path(spark, "source")
    raw.withColumn("main_aqi", level).repartitionByRange("event_id").sortWithinPartitions("event_id").write.parquet(source)
    landed = files.land_first(spark, ["/not/there.csv", source], scratch_path(spark, "landed"))
    columns = files.column_names(spark, landed)
    return files.load_readings(spark, [landed]).select("city", "datetime", *[c for c in MEASURED if c in columns])


@query
def landed_in_parts(spark, sf_dir):
    """The same readings from files that arrive one after the other: each call lands only what is new."""
    raw = raw_readings(spark, sf_dir).withColumn("city", F.concat(F.upper("city"), F.lit(" ")))
    level = F.when(F.col("components_pm2_5") >= DROPOUT_BELOW, F.col("main_aqi"))
    laid = materialise(raw.withColumn("main_aqi", level), "source")
    work, (low, high) = scratch_path(spark, "arriving"), laid.approxQuantile("event_id", [0.33, 0.66], 0.01)
    sides = (F.col("event_id") <= low, F.col("event_id").between(low + 1, high), F.col("event_id") > high)
    for part, inside in enumerate(sides, 1):
        rows = laid.filter(inside)
        rows.repartitionByRange(2, "event_id").sortWithinPartitions("event_id").write.parquet(f"{work}/source/{part}")
        files.land_more(spark, [f"{work}/source/{i}" for i in range(1, part + 1)], f"{work}/landed")
    return files.load_landed(spark, f"{work}/landed").select("city", "datetime", *MEASURED)


@query
def training_run_log(spark, sf_dir):
    """The whole training run over the stored readings: what it stored and logged, then the hold-out evaluation."""
    work, source = scratch_path(spark, "training"), scratch_path(spark, "source")
    readings(spark, sf_dir).write.parquet(source)
    done = training_run(spark, ["/not/there.parquet", source], work, CUTOFF, TREES, DEPTH)
    logged = records.latest_run(records.run_log(spark, f"{work}/runs")).first()
    table = spark.read.parquet(f"{work}/features")
    (tn, fp), (fn, tp) = done["metrics"]["classification"]["confusion_matrix"]
    tested = evaluate_on_test(spark, source, f"{work}/models")
    baseline = records.load_baseline(spark, f"{work}/baseline")
    rows = [
        ("feature rows", table.count()),
        ("validated rows", tn + fp + fn + tp),
        ("validated hazards", fn + tp),
        ("tested rows", sum(map(sum, tested["classification"]["confusion_matrix"]))),
        ("baseline features", baseline.count()),
        ("sampled rows", files.read_text_table(spark, f"{work}/current_sample").count()),
        ("logged metrics agree", int(logged["reg_rmse"] == done["metrics"]["regression"]["rmse"])),
        ("models in production", sum("/production/" in p for p in model_paths(spark, f"{work}/models").values())),
    ]
    return spark.createDataFrame(rows, "what string, n long")


@query
def quality_gates(spark, sf_dir):
    """What passes all gates, behaviour of the models included: the later side as it is, with a level out of range, with
    one column moved, and beside a model whose levels are ten times too high."""
    table = materialise(features(spark, sf_dir), "features")
    train, val = splits.train_val(table, CUTOFF)
    baseline = materialise(drift.baseline_stats(table, MEASURED), "baseline")
    models = train_all(train, 2, 2)
    scaled = train_regressor(train.withColumn(TARGET, F.col(TARGET) * 10), _inputs(train), trees=2, depth=2)
    cases = {
        "as it is": val,
        "wrong model": val,
        "level out of range": val.withColumn("main_aqi", F.col("main_aqi") + 5),
        "moved column": val.withColumn("components_pm10", F.col("components_pm10") * 0 + 1e6),
    }
    rows = []
    for name, sample in cases.items():
        try:
            judged = {**models, "regressor": scaled} if name == "wrong model" else models
            run_checks(sample.select("city", "datetime", *MEASURED, HAZARD), baseline, judged)
            rows.append((name, True))
        except ContractError:
            rows.append((name, False))
    scored = materialise(score(val, models), "scored")
    rows.append(("predictions", checks.prediction_report(scored, "aqi_3h").filter("violations > 0").isEmpty()))
    return spark.createDataFrame(rows, "sample string, passed boolean")


@query
def contract_inputs(spark, sf_dir):
    """The model inputs that the feature table carries and lacks, in contract order."""
    built = features(spark, sf_dir)
    held, n = feature_columns(built), built.count()
    rows = [(i, c, n if c in held else 0) for i, c in enumerate(FEATURES)]
    return spark.createDataFrame(rows, "place int, feature string, n_rows long")


@query
def contract_rows(spark, sf_dir):
    """The model inputs that the feature table carries, in contract order, beside the time of each row."""
    built = features(spark, sf_dir)
    held = serving_columns(built)
    return built.select("datetime", *[r6(c).alias(c) if c in ROLLED_OUT else F.col(c) for c in held])


@query
def imputed_city(spark, sf_dir):
    """Most frequent city, as the imputer uses it."""
    return spark.createDataFrame([(impute_values(raw_readings(spark, sf_dir), ["city"])["city"],)], "city string")


# --- Streams ---------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = events(spark, sf_dir).schema
    return jobs.file_stream(spark, f"{sf_dir}/events*.parquet", schema).select("event_id", *reading_columns())


@query
def stream_dedup(spark, sf_dir):
    out = jobs.run_unique(_event_stream(spark, sf_dir), scratch_path(spark, "stream-dedup"), "event_id")
    return jobs.read_unique(spark, out, "event_id")


@query
def stream_counters(spark, sf_dir):
    work = scratch_path(spark, "stream-counters")
    log = _event_stream(spark, sf_dir).select("city", (F.col("components_pm2_5") >= 1).alias("ok"))
    jobs.run_to_end(jobs.snapshot_to_files(jobs.counter_stream(log), f"{work}/out", f"{work}/checkpoint"))
    return jobs.latest_snapshot(spark, f"{work}/out")


@query
def stream_scoring(spark, sf_dir):
    """Every distinct (city, hour) of the stream scored with models trained on the batch side."""
    train, _ = _train_val(spark, sf_dir)
    models = train_all(train, TREES, DEPTH)
    work = scratch_path(spark, "stream-scoring")
    out = jobs.run_unique(_event_stream(spark, sf_dir), work, "event_id", jobs.score_rows(models, "stored/tree", "event_id"))
    based = F.col("record.recommendations.based_on")
    return jobs.read_shaped(spark, out, "event_id").select(
        "city",
        "datetime",
        F.col("record.realtime.current_aqi").alias("current_aqi"),
        F.col("record.prediction.hazard_prob").between(0, 1).alias("is_probability"),
        (F.col("record.prediction.hazard_label") == lab.hazard_text(based["predicted_aqi"])).alias("label_follows_level"),
        based["recommender_model"].alias("recommender_model"),
    )


@query
def stream_history(spark, sf_dir):
    """Lags and rolling means of every reading, kept up to date by a stream that takes a day's events at a time."""
    work = scratch_path(spark, "stream-history")
    raw = raw_readings(spark, sf_dir).withColumn("day", F.dayofmonth("datetime"))
    # Odd days land first, so every other file is late.
    raw.withColumn("turn", F.col("day") % 2).repartitionByRange(4, F.desc("turn"), "day").drop("day", "turn").write.parquet(f"{work}/landed")
    stream = jobs.file_stream(spark, f"{work}/landed", spark.read.parquet(f"{work}/landed").schema, 1)
    out = jobs.run_unique(stream, work, "event_id", lambda rows: rows, width="5d", history=True)
    found = jobs.read_shaped(spark, out, "event_id")
    return found.select("city", "datetime", *MEASURED, *[c for c in found.columns if "_lag_" in c], *[r6(c).alias(c) for c in found.columns if "_roll3_" in c])


@query
def stream_predictions(spark, sf_dir):
    """What three plain trees predict for every reading of the stream, from its own history."""
    train, _ = _train_val(spark, sf_dir)
    models = _plain_trees(coarse(train))
    work = scratch_path(spark, "stream-predictions")

    def shape(rows):
        calm = add_calendar(coarse(rows)).dropna(subset=COARSE)
        return score(calm, models).select("city", "datetime", "aqi_3h", "hazard_class", "hazard_prob", "severity_model")

    out = jobs.run_unique(_event_stream(spark, sf_dir), work, "event_id", shape, width="5d", history=True)
    return _predictions(jobs.read_shaped(spark, out, "event_id"))
