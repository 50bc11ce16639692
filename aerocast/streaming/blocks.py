"""Unique rows of a stream in time blocks, which batches rewrite as they touch them.

A block is a folder with one version per batch that changed it; a version holds all rows of the block. A batch
looks only at the blocks of its own rows, so what it reads follows the batch, not the history, and a key
that arrives years late is found like any other. A repeated batch replaces its own versions and starts from those
of earlier batches, and readers stop at the last batch that ran to its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.contract import LAG_STEPS, LAGGED, ROLL_ROWS, ROLLED
from aerocast.operators.readings import first_per_key
from aerocast.operators.series import block_id, mean_of, row_shifts
from aerocast.session import materialise
from aerocast.sources.files import path_exists

BLOCK, VERSION = "time_block", "version"
#: Width of a block: a day of hourly readings; denser sources pass a finer one.
WIDTH = "1d"


def _children(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getPath().getName() for f in found]


def _numbers(names: list[str], prefix: str) -> list[int]:
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def commit(spark: SparkSession, out: str, batch_id: int) -> None:
    """Mark a batch as complete."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/commits/batch={batch_id}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(marker)


def last_commit(spark: SparkSession, out: str) -> int:
    """The newest complete batch, -1 without one."""
    return max(_numbers(_children(spark, f"{out}/commits"), "batch="), default=-1)


def all_blocks(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the blocks there are; the calendar bounds them."""
    return _numbers(_children(spark, f"{out}/rows"), f"{BLOCK}=")


def versions(spark: SparkSession, out: str, block: int, until: int) -> list[int]:
    """Versions of a block that batches up to ``until`` wrote."""
    return [v for v in _numbers(_children(spark, f"{out}/rows/{BLOCK}={block}"), f"{VERSION}=") if v <= until]


def block_paths(spark: SparkSession, out: str, chosen: list[int], until: int) -> list[str]:
    """Folders with the newest version, up to ``until``, of each chosen block."""
    newest = {b: versions(spark, out, b, until)[-1:] for b in chosen}
    return [f"{out}/rows/{BLOCK}={b}/{VERSION}={v[0]}" for b, v in newest.items() if v]


def read_blocks(spark: SparkSession, out: str, chosen: list[int], until: int, schema=None) -> DataFrame | None:
    """Rows of the chosen blocks with their ``time_block``; none if no such block was written."""
    paths = block_paths(spark, out, chosen, until)
    if not paths:
        return None
    reader = spark.read.option("basePath", f"{out}/rows")
    return (reader.schema(schema) if schema else reader).parquet(*paths).drop(VERSION)


def read_all(spark: SparkSession, out: str) -> DataFrame:
    return read_blocks(spark, out, all_blocks(spark, out), last_commit(spark, out))


def upsert(batch: DataFrame, out: str, batch_id: int, order: str, width: str = WIDTH) -> DataFrame | None:
    """Bring a batch into the blocks; gives the rows that are new or better, none if there are none.

    The numbers of the touched blocks come to the driver, as paths are made from them.
    """
    spark = batch.sparkSession
    known = batch.filter("city IS NOT NULL AND datetime IS NOT NULL")
    rows = _first(known.withColumn(BLOCK, block_id(F.col("datetime"), width)), order)
    touched = [r[0] for r in rows.select(BLOCK).distinct().collect()]
    held = read_blocks(spark, out, touched, batch_id - 1, rows.withColumn(VERSION, F.lit(0).cast("bigint")).schema)
    if held is not None:
        there = held.select("city", "datetime", F.col(order).alias("_held"))
        same = (rows["city"] == there["city"]) & (rows["datetime"] == there["datetime"])
        # An equal order is not better, and a row without one loses against any with one. Two rows without are both
        # kept here: the whole block decides between them, as a single batch would.
        loses = (there["_held"] <= rows[order]) | (rows[order].isNull() & there["_held"].isNotNull())
        rows = rows.join(there, same & loses, "left_anti")
    path = f"{out}/changes/batch={batch_id}"
    rows.write.mode("overwrite").parquet(path)
    changed = spark.read.schema(rows.schema).parquet(path)
    touched = [r[0] for r in changed.select(BLOCK).distinct().collect()]
    if not touched:
        return None
    held = read_blocks(spark, out, touched, batch_id - 1, rows.withColumn(VERSION, F.lit(0).cast("bigint")).schema)
    whole = changed if held is None else _first(held.unionByName(changed), order)
    written = whole.withColumn(VERSION, F.lit(batch_id).cast("bigint")).hint("rebalance", F.col(BLOCK))
    written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK, VERSION).parquet(f"{out}/rows")
    for b in touched:
        # A repeated batch starts from the version before its own; older ones have no reader.
        for old in versions(spark, out, b, batch_id - 1)[:-1]:
            _remove(spark, f"{out}/rows/{BLOCK}={b}/{VERSION}={old}")
    if batch_id:
        _remove(spark, f"{out}/changes/batch={batch_id - 1}")
    return changed.drop(BLOCK)


def _first(rows: DataFrame, order: str) -> DataFrame:
    """First row per key, with its order. Columns are sorted, as rows without an order follow a hash over all."""
    rows = rows.select(*sorted(rows.columns))
    return first_per_key(rows.withColumn("_order", F.col(order)), order=order).withColumnRenamed("_order", order)


def _runs(existing: list[int], touched: list[int], reach: int) -> list[list[int]]:
    """Existing blocks up to ``reach`` places around the touched ones, as runs of neighbours."""
    place = {b: i for i, b in enumerate(existing)}
    near = sorted({j for b in touched for j in range(place[b] - reach, place[b] + reach + 1) if 0 <= j < len(existing)})
    runs: list[list[int]] = []
    for i, j in enumerate(near):
        if not i or near[i - 1] != j - 1:
            runs.append([])
        runs[-1].append(existing[j])
    return runs


def with_history(changed: DataFrame, out: str, batch_id: int, width: str = WIDTH) -> DataFrame:
    """Rows whose history a batch changed, with lags and rolling means from the rows before them.

    These are the changed rows and, as rows may arrive late, the next ones of their city. Only blocks around the changed
    ones are read: one more on each side, then twice as many, until every changed row has the rows it needs or
    the series ends.
    """
    spark = changed.sparkSession
    existing = all_blocks(spark, out)
    marks = changed.select("city", "datetime", F.lit(1).alias("_changed"))
    touched = [r[0] for r in changed.select(block_id(F.col("datetime"), width)).distinct().collect()]
    lagged = [c for c in LAGGED if c in changed.columns]
    means = [c for c in ROLLED if c in changed.columns]
    spec = {f"{c}_lag_{k}": (c, k) for c in lagged for k in range(1, LAG_STEPS + 1)}
    spec |= {f"_changed_{k}": ("_changed", k) for k in range(1, LAG_STEPS + 1)}
    spec |= {"_back": ("datetime", LAG_STEPS), "_ahead": ("datetime", -LAG_STEPS)}
    reach = 1
    while True:
        runs = _runs(existing, touched, reach)
        run_of = {b: i for i, run in enumerate(runs) for b in run}
        rows = read_blocks(spark, out, list(run_of), batch_id)
        numbers = spark.createDataFrame(
            [(b, i, runs[i][0] == existing[0], runs[i][-1] == existing[-1]) for b, i in run_of.items()],
            f"{BLOCK} bigint, _run int, _starts boolean, _ends boolean",
        )
        # One small row per block read; runs apart from each other are series of their own.
        rows = rows.join(F.broadcast(numbers), BLOCK).join(marks, ["city", "datetime"], "left").drop(BLOCK)
        apart = rows.withColumns({"_city": F.col("city"), "city": F.concat_ws("|", "_run", "city")})
        placed = materialise(row_shifts(apart, spec, width), "history")
        short = "_changed = 1 AND (_back IS NULL AND NOT _starts OR _ahead IS NULL AND NOT _ends)"
        if placed.filter(short).isEmpty():
            break
        reach *= 2
    affected = placed.filter("coalesce(_changed, _changed_1, _changed_2, _changed_3) = 1").withColumn("city", F.col("_city"))
    parts = {c: [f"`{c}_lag_{k}`" for k in range(ROLL_ROWS - 1, 0, -1)] + [f"`{c}`"] for c in means}
    rolled = {f"{c}_roll{ROLL_ROWS}_mean": F.expr(mean_of(p)) for c, p in parts.items()}
    lags = [f"{c}_lag_{k}" for c in lagged for k in range(1, LAG_STEPS + 1)]
    return affected.withColumns(rolled).select(*changed.columns, *lags, *rolled)
