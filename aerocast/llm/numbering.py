"""Gapless numbers inside groups of any size, with native expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str, buckets: int | None = None) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... without gaps inside each group of ``keys``.

    A group is dealt into hash buckets of the order columns, rows are numbered inside a bucket
    and the sizes of the buckets before it are added, so no group meets in one task. The keys
    must not be null. Rows alike in all order columns share a bucket and are numbered in any order.
    ``buckets`` defaults to the session's number of shuffle partitions.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, "_bucket").agg(F.count("*").alias("_size"))
    offsets = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    joined = ranked.join(offsets, [*keys, "_bucket"])
    return joined.withColumn(name, F.col("_before") + F.col("_rank")).drop("_bucket", "_before", "_rank")
