"""Model storage: trained, production and baseline models with their metadata."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aerocast.contract import HORIZON, MODEL_VERSION
from aerocast.sources.files import path_exists
from aerocast.sources.records import read_record, utc_now, write_record

ROLES = ("regressor", "classifier", "recommender")


class MissingModel(FileNotFoundError):
    """No usable model is stored."""


def save_models(spark: SparkSession, models: dict[str, PipelineModel], root: str, metadata: dict) -> dict[str, str]:
    """Store models and one metadata record under a root folder."""
    paths = {}
    for role, model in models.items():
        paths[role] = f"{root}/{role}"
        model.write().overwrite().save(paths[role])
    record = {"model_version": MODEL_VERSION, "horizon_hours": HORIZON, "created_at": utc_now(), **metadata}
    paths["metadata"] = write_record(spark, record, f"{root}/metadata")
    return paths


def copy_tree(spark: SparkSession, source: str, target: str) -> None:
    """Copy a stored model to a path that does not exist yet."""
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    src, dst = fs.Path(source), fs.Path(target)
    there = dst.getFileSystem(conf)
    there.mkdirs(dst.getParent())
    if not fs.FileUtil.copy(src.getFileSystem(conf), src, there, dst, False, False, conf):
        raise OSError(f"could not copy {source} to {target}")


def switch_production(spark: SparkSession, base: str, version: str) -> None:
    """Make a complete version the current one: one row more in the log of versions."""
    row = spark.createDataFrame([(utc_now(), version)], "at string, version string")
    row.coalesce(1).write.mode("append").parquet(f"{base}/log")


def production_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the current production version; null if there was no promotion."""
    base = f"{root}/production"
    if not path_exists(spark, f"{base}/log"):
        return None
    newest = spark.read.parquet(f"{base}/log").agg(F.max_by("version", "at")).first()[0]
    return f"{base}/{newest}"


def new_version(root: str) -> tuple[str, str]:
    """Name and folder of a version that is not in use yet."""
    version = f"v-{uuid.uuid4().hex}"
    return version, f"{root}/production/{version}"


def promote(spark: SparkSession, paths: dict[str, str], root: str, metrics: dict, run_id: str | None = None) -> dict[str, str]:
    """Copy trained models to a new production version, record their origin, then switch to it.

    A copy that fails leaves the current version in place, and a version holds only the roles
    of its own run.
    """
    run, (version, base) = run_id or utc_now(), new_version(root)
    produced = {role: f"{base}/{role}" for role in ROLES if role in paths}
    for role, target in produced.items():
        copy_tree(spark, paths[role], target)
    source = read_record(spark, paths["metadata"]) if "metadata" in paths else {}
    record = {**source, "source_models": paths, "metrics": metrics, "training_run_id": run, "created_at": utc_now()}
    metadata = write_record(spark, record, f"{base}/metadata")
    switch_production(spark, f"{root}/production", version)
    return {**produced, "metadata": metadata, "training_run_id": run}


def save_production(spark: SparkSession, models: dict[str, PipelineModel], root: str, metadata: dict) -> dict[str, str]:
    """Store models directly as a new production version and switch to it."""
    version, base = new_version(root)
    paths = save_models(spark, models, base, metadata)
    switch_production(spark, f"{root}/production", version)
    return paths


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a model was stored to its end: its metadata is the first part, marked when written."""
    return path_exists(spark, f"{path}/metadata/_SUCCESS") and path_exists(spark, f"{path}/stages")


def model_path(spark: SparkSession, root: str, role: str) -> str:
    """Where the model of a role is: in production, else the trained baseline, else a clear error."""
    production = production_path(spark, root)
    tried = [f"{base}/{role}" for base in (production, root) if base]
    for path in tried:
        if is_complete(spark, path):
            return path
    raise MissingModel(f"no {role} model found, tried {tried}; train the models first")


def load_model(spark: SparkSession, root: str, role: str) -> PipelineModel:
    """The model of a role; problems other than a missing store are raised, not skipped."""
    return PipelineModel.load(model_path(spark, root, role))


def model_paths(spark: SparkSession, root: str, roles=ROLES) -> dict[str, str]:
    """Where serving finds its models; the recommender is optional (rules stand in for it)."""
    production = production_path(spark, root)
    if production and all(is_complete(spark, f"{production}/{r}") for r in roles if r != "recommender"):
        # A usable version is used alone, so that models of different runs are not mixed.
        return {r: f"{production}/{r}" for r in roles if is_complete(spark, f"{production}/{r}")}
    paths = {}
    for role in roles:
        try:
            paths[role] = model_path(spark, root, role)
        except MissingModel:
            if role != "recommender":
                raise
    return paths


def load_models(spark: SparkSession, root: str, roles=ROLES) -> dict[str, PipelineModel]:
    """All models that serving needs; see ``model_paths`` for where they come from."""
    return {role: PipelineModel.load(path) for role, path in model_paths(spark, root, roles).items()}


def load_production(spark: SparkSession, root: str) -> tuple[dict[str, PipelineModel], dict]:
    """Regressor, classifier and metadata of the production version only."""
    base = production_path(spark, root)
    needed = ("regressor", "classifier")
    if not base or not all(is_complete(spark, f"{base}/{role}") for role in needed):
        raise MissingModel("production models not found; train and promote first")
    return {role: PipelineModel.load(f"{base}/{role}") for role in needed}, read_record(spark, f"{base}/metadata")
