"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call-site capture makes building large plans in Python several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "aerocast", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults the jobs rely on; a cluster's own settings win if given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root folder for cut lineage, stream state and working tables.

    The cluster names it in ``spark.checkpoint.dir``; without that setting it lies in the
    warehouse of the session, which every executor reaches as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/aerocast-work"


def scratch_path(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A fresh, not yet existing path under ``root``, or else under the shared folder."""
    return f"{root or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, root: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, from ``root`` or else from the shared folder.

    A job gives the run folder below its own work path as ``root``, so that all its working
    tables can be removed with that folder.

    Used where several jobs read the same expensive plan: the written table cuts the
    lineage and survives lost executors.
    """
    path = scratch_path(df.sparkSession, label, root)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
