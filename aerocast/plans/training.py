"""Batch jobs: build features, train, evaluate, promote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerocast.contract import HORIZON, TRAIN_CUTOFF, feature_columns
from aerocast.models.registry import load_production, promote, save_models, save_production
from aerocast.models.training import DEPTH, TREES, score, train_all, train_classifier, train_regressor, fit_preprocessor
from aerocast.operators.checks import check_features, check_predictions, check_raw
from aerocast.operators.profile import split_periods
from aerocast.operators.sampling import sample_rows
from aerocast.operators.series import BLOCK, forecast_features
from aerocast.operators.splits import mark_split, train_val
from aerocast.plans.evaluate import check_feature_list, evaluate
from aerocast.session import materialise, scratch_path
from aerocast.sources.files import land_first, load_features, load_readings, write_by_month, write_csv
from aerocast.sources.records import log_run, save_baseline, write_record


def build_offline_features(
    spark: SparkSession, source: str, out: str, horizon: int = HORIZON, block: str = BLOCK, root: str | None = None
) -> str:
    """Readings to a stored feature table; ``block`` is the width of the time blocks of a series.

    Working tables go to ``root``, or else to the session's shared folder.
    """
    # Border rows are read separately from the wide rows, so the unique readings are stored
    # once instead of being deduplicated for each.
    rows = materialise(load_readings(spark, [source]), "readings", root)
    return write_by_month(forecast_features(rows, horizon, block), out, root)


def feature_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored feature table without its layout columns."""
    return load_features(spark, path).drop("month_part")


def train_and_report(
    df: DataFrame, cutoff: str = TRAIN_CUTOFF, trees: int = TREES, depth: int = DEPTH, root: str | None = None
) -> dict:
    """Split by time, train regressor and classifier, evaluate on the later side."""
    train, val = train_val(df, cutoff)
    columns = feature_columns(df)
    prepared = fit_preprocessor(train, columns)
    models = {
        "regressor": train_regressor(train, columns, prepared, trees, depth),
        "classifier": train_classifier(train, columns, prepared, trees, depth),
    }
    metrics = evaluate(materialise(score(val, models), "scored", root))
    return {"models": models, "metrics": metrics, "feature_columns": columns}


def periods(df: DataFrame, cutoff: str = TRAIN_CUTOFF) -> dict[str, dict]:
    """Start, end and rows of both sides of the split (two rows)."""
    rows = split_periods(mark_split(df, cutoff)).collect()
    return {r["split"]: {"start": str(r["start"]), "end": str(r["end"]), "rows": r["n"]} for r in rows}


def train_from_table(spark: SparkSession, features: str, root: str, cutoff: str = TRAIN_CUTOFF, trees: int = TREES, depth: int = DEPTH) -> dict:
    """Train on a stored feature table and store the result as production models."""
    df = feature_table(spark, features)
    done = train_and_report(df, cutoff, trees, depth, f"{root}/work")
    metadata = {"feature_columns": done["feature_columns"], "metrics": done["metrics"], "periods": periods(df, cutoff)}
    save_production(spark, done["models"], root, metadata)
    return done["metrics"]


def evaluate_on_test(spark: SparkSession, source: str, root: str, horizon: int = HORIZON, block: str = BLOCK) -> dict:
    """Score a hold-out set with the production models and their stored feature list."""
    models, metadata = load_production(spark, root)
    rows = materialise(load_readings(spark, [source]), "readings", f"{root}/work")
    df = forecast_features(rows, horizon, block)
    check_feature_list(df, metadata["feature_columns"])
    return evaluate(materialise(score(df, models), "holdout", f"{root}/work"))


def training_run(
    spark: SparkSession,
    candidates: list[str],
    work: str,
    cutoff: str = TRAIN_CUTOFF,
    trees: int = TREES,
    depth: int = DEPTH,
    block: str = BLOCK,
    notes: str = "automated training run",
) -> dict:
    """The whole run: land, features, checks, baseline, three models, evaluation, promotion, log.

    Every stage that later stages read more than once is a written table under ``work``, so a
    lost executor costs a task, not the lineage. Tables that only this run needs lie in its own
    folder below ``work``/run.
    """
    scratch = scratch_path(spark, "run", f"{work}/run")
    landed = land_first(spark, candidates, f"{work}/ingested")
    # The feature table is read by every later step; it is written once.
    built = build_offline_features(spark, landed, f"{work}/features", block=block, root=scratch)
    df = feature_table(spark, built)
    check_raw(df)
    train, val = train_val(df, cutoff)
    check_features(train)
    save_baseline(df, feature_columns(df), f"{work}/baseline")
    write_csv(sample_rows(df).select("city", "datetime", *[c for c in feature_columns(df) if c != "city"]), f"{work}/current_sample")

    models = train_all(train, trees, depth)
    root = f"{work}/models"
    paths = save_models(spark, models, root, {"feature_columns": feature_columns(df), "periods": periods(df, cutoff)})
    scored = materialise(score(val, models), "scored", scratch)
    check_predictions(scored, "aqi_3h")
    metrics = evaluate(scored)
    write_record(spark, metrics, f"{work}/metrics")
    produced = promote(spark, paths, root, metrics)
    log_run(
        spark,
        f"{work}/runs",
        produced["training_run_id"],
        metrics["regression"],
        metrics["classification"],
        metrics["recommender"],
        produced,
        notes,
    )
    return {"metrics": metrics, "paths": produced}
