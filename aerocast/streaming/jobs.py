"""Score, count and deduplicate arriving readings.

The jobs read landed Parquet files and process what is available (or run on a schedule with
another trigger). Checkpoints and outputs live under paths the caller names; on a cluster
these belong in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerocast.contract import ENGINEERED
from aerocast.models.training import score
from aerocast.operators.readings import ROW_ORDER
from aerocast.operators.scoring import cold_start_features, prediction_records
from aerocast.sources.files import path_exists
from aerocast.streaming import blocks
from aerocast.streaming.blocks import WIDTH


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a folder or glob, with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def unique_to_files(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    order: str = ROW_ORDER,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    width: str = WIDTH,
    history: bool = False,
) -> StreamingQuery:
    """Keep the first row per (city, datetime) of a stream, over all files available now.

    Rows live in time blocks of ``width`` (see ``streaming.blocks``). A batch reads the blocks that it touches,
    whatever was written before, and rewrites those where a key is new or comes with a smaller ``order``. The
    result does not depend on how files fall into batches or on their order, nothing is dropped as late, and
    no state is kept in memory.

    ``shape`` adds columns to the rows that changed. With ``history`` it gets every row whose lags or
    rolling means changed, with these columns from the rows before it (see ``blocks.with_history``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = blocks.upsert(batch, out, batch_id, order, width)
        if shape is not None and changed is not None:
            rows = blocks.with_history(changed, out, batch_id, width) if history else changed
            shape(rows).write.mode("overwrite").parquet(f"{out}/shaped/batch={batch_id}")
        blocks.commit(spark, out, batch_id)

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(availableNow=True).start()


def read_unique(spark: SparkSession, out: str, order: str = ROW_ORDER) -> DataFrame:
    """The rows that ``unique_to_files`` keeps, each key once: blocks hold nothing else."""
    return blocks.read_all(spark, out).drop(order, blocks.BLOCK)


def read_shaped(spark: SparkSession, out: str, order: str = ROW_ORDER) -> DataFrame:
    """The shaped rows, each key once, as the last batch that touched it left it; ``shape`` must keep city and time."""
    done = blocks.last_commit(spark, out)
    rows = spark.read.parquet(f"{out}/shaped").filter(F.col("batch") <= done)
    rest = [c for c in rows.columns if c not in ("city", "datetime", "batch", order)]
    return rows.groupBy("city", "datetime").agg(*[F.max_by(c, "batch").alias(c) for c in rest])


def score_rows(
    models: dict[str, PipelineModel], recommender: str | None = None, order: str = ROW_ORDER
) -> Callable[[DataFrame], DataFrame]:
    """A shape for ``unique_to_files``: prediction records beside the key of their reading.

    Rows that come without lags and rolling means, or at the start of a series, repeat the current value in them.
    """

    def shape(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumns({"_key": F.col("city"), "_order": F.col(order)})
        known = {c: f"_known_{c}" for c in ENGINEERED if c in rows.columns}
        cold = cold_start_features(keyed.withColumnsRenamed(known))
        filled = cold.withColumns({c: F.coalesce(k, c) for c, k in known.items()}).drop(*known.values())
        scored = score(filled, models)
        record = prediction_records(scored, recommender, carried=["_key", "datetime", "_order"])
        return record.select(
            F.col("_key").alias("city"),
            "datetime",
            F.col("_order").alias(order),
            F.struct(*[c for c in record.columns if c not in ("_key", "datetime", "_order")]).alias("record"),
        )

    return shape


def counter_stream(log: DataFrame) -> DataFrame:
    """Requests, successes and failures per city; ``ok`` marks a success."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    return log.groupBy("city").agg(
        F.count("*").alias("total"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed")
    )


def snapshot_to_files(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest complete result of an aggregation, one folder per batch.

    A repeated batch overwrites its own folder, so a restart does not double anything.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(availableNow=True).start()


def latest_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The result of the newest complete batch; only that folder is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found]
    batches = sorted((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), reverse=True)
    newest = next(b for b in batches if path_exists(spark, f"{out}/batch={b}/_SUCCESS"))
    return spark.read.parquet(f"{out}/batch={newest}")


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def run_unique(stream: DataFrame, work: str, order: str = ROW_ORDER, shape=None, width: str = WIDTH, history: bool = False) -> str:
    """Run ``unique_to_files`` over all available files into ``work``/out."""
    run_to_end(unique_to_files(stream, f"{work}/out", f"{work}/checkpoint", order, shape, width, history))
    return f"{work}/out"
