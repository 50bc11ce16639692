"""Small stored records: drift baseline, metrics, model metadata, run log."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.operators.drift import baseline_stats
from aerocast.sources.files import path_exists

BASELINE_SCHEMA = "feature string, bins array<double>, ref array<double>"
RUN_SCHEMA = (
    "timestamp_utc string, run_id string, reg_rmse double, reg_mae double, reg_r2 double, "
    "clf_accuracy double, clf_f1 double, clf_roc_auc double, rec_accuracy double, "
    "reg_model_path string, clf_model_path string, rec_model_path string, metadata_path string, notes string"
)


def utc_now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"


def save_baseline(df: DataFrame, columns: list[str], path: str, bins: int = 5) -> str:
    """Store edges and bin fractions per column as JSON lines, one per column."""
    baseline_stats(df, columns, bins).repartition(1).write.mode("overwrite").json(path)
    return path


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"drift baseline not found at {path}")
    return spark.read.schema(BASELINE_SCHEMA).json(path)


def write_record(spark: SparkSession, record: dict, path: str) -> str:
    """Store one nested record as a JSON row."""
    row = spark.createDataFrame([(json.dumps(record),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_record(spark: SparkSession, path: str) -> dict:
    """The stored record (one row)."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"record not found at {path}")
    return json.loads(spark.read.text(path).first()[0])


def production_info(spark: SparkSession, path: str) -> dict:
    """Metadata of the production models, or a status that says why there is none."""
    try:
        return read_record(spark, path)
    except FileNotFoundError:
        return {"status": "no_production_metadata", "message": f"{path} not found; baseline models are used"}
    except Exception as problem:  # unreadable file or malformed JSON
        return {"status": "error", "message": f"could not read {path}: {problem}"}


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    regression: dict,
    classification: dict,
    recommender: dict,
    model_paths: dict,
    notes: str = "",
    at: str | None = None,
) -> None:
    """Append one run to the log."""
    row = (
        at or utc_now(),
        run_id,
        regression.get("rmse"),
        regression.get("mae"),
        regression.get("r2"),
        classification.get("accuracy"),
        classification.get("f1"),
        classification.get("roc_auc"),
        recommender.get("accuracy"),
        model_paths.get("regressor"),
        model_paths.get("classifier"),
        model_paths.get("recommender"),
        model_paths.get("metadata"),
        notes or "",
    )
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def latest_run(log: DataFrame) -> DataFrame:
    """The newest run of a log, one row."""
    return log.agg(F.max_by(F.struct(*log.columns), "timestamp_utc").alias("r")).select("r.*")
