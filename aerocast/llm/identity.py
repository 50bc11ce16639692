"""Ids of texts where an id does not tell them apart.

Operators know a text by its ``doc_id``. Where rows share an id and differ in text, each text gets a number of its
own for the time of the job; numbers follow (id, text hash), so that "the smaller id first" stays true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocast.llm.words import free_name
from aerocast.session import materialise

#: Keys that are numbered as one range.
RANGE_ROWS = 1_000_000


def _hashes() -> list[Column]:
    """128 bits of the text; a null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit("second"), text).alias("_h2")]


def text_numbers(docs: DataFrame) -> DataFrame | None:
    """Stored ``doc_id, _h1, _h2, number`` of all texts with an id; none where every id has one text.

    Looking for ids of several texts shuffles an id and two hashes a row.
    """
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_hashes()).filter("doc_id IS NOT NULL")
    spread = [F.min("_h1") != F.max("_h1"), F.min("_h2") != F.max("_h2")]
    if keys.groupBy("doc_id").agg((spread[0] | spread[1]).alias("several")).filter("several").isEmpty():
        return None
    keys = materialise(keys.distinct(), "text-keys")
    order = ["doc_id", "_h1", "_h2"]
    ranges = int(keys.count() // RANGE_ROWS) + 1
    dealt = materialise(keys.repartitionByRange(ranges, *order).withColumn("_part", F.spark_partition_id()), "text-ranges")
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per range is summed in order.
    sizes = sizes.select("_part", F.coalesce(F.sum("_size").over(along), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    numbered = dealt.withColumn("_rank", inside).join(F.broadcast(sizes), "_part")
    return materialise(numbered.select(*order, (F.col("_before") + F.col("_rank")).alias("number")), "text-numbers")


def renumber(docs: DataFrame, numbers: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with numbers in place of ids, and the name of the column added last, which keeps the ids."""
    own, first, second, key, a, b, number = (free_name(n, docs.columns) for n in ("_own_id", "_t1", "_t2", "_tid", "_n1", "_n2", "_number"))
    hashed = docs.withColumns(dict(zip((first, second), _hashes())))
    known = numbers.select(F.col("doc_id").alias(key), F.col("_h1").alias(a), F.col("_h2").alias(b), F.col("number").alias(number))
    same = (F.col("doc_id").cast("long") == F.col(key)) & (F.col(first) == F.col(a)) & (F.col(second) == F.col(b))
    joined = hashed.join(known.hint("merge"), same, "left")
    columns = [F.col(number).alias(c) if c == "doc_id" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.col("doc_id").alias(own)), own


def restore(out: DataFrame, docs: DataFrame, own: str) -> DataFrame:
    """``out`` of the columns of ``renumber`` with the ids back in place."""
    return out.select(*[F.col(own).alias(c) if c == "doc_id" else F.col(f"`{c}`") for c in docs.columns])


def ids_of(out: DataFrame, numbers: DataFrame, columns: list[str]) -> DataFrame:
    """``out`` with ids in place of the numbers in the given columns."""
    for c in columns:
        known = numbers.select(F.col("number").alias("_number"), F.col("doc_id").alias("_id"))
        joined = out.join(known, F.col(c) == F.col("_number"), "left")
        out = joined.select(*[F.col("_id").alias(n) if n == c else F.col(n) for n in out.columns])
    return out
