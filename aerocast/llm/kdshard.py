"""Shards of near equal bytes by a k-d tree over the metadata of documents.

A node with several shards is cut at the weighted median of its widest dimension, where the
weights are bytes and the median is the share of the shards that go left; leaves hold the target
bytes, the total divided by the number of shards. Coordinates are 24-bit numbers. Rows equal in a
dimension are told apart by 24 bits of a hash, so that a single source, language or size with a
third of all rows is cut as evenly as any other. A median is found by narrowing a histogram of
bytes: each pass sums the bytes of 65,536 bins per node and keeps one bin. Only expressions of
DataFrames are used, and only one row per node and dimension reaches the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocast.llm.numbering import number_rows
from aerocast.session import materialise

#: Bytes that a document costs besides its text.
OVERHEAD = 16
BITS = 24
STEP = 16
LIMIT = (1 << BITS) - 1
#: A median is narrowed no further when its bin has one row or less than this share of a leaf.
TOLERANCE = 0.0005


@dataclass
class Node:
    """A cell of the tree: its shards, and once cut the dimension, the cut and both sides."""

    first: int
    shards: int
    index: int
    axis: str = ""
    cut: int = 0
    low: Node | None = None
    high: Node | None = None


def _scaled(value: Column, low: float, high: float) -> Column:
    """A number brought to 0..LIMIT; null counts as the lowest."""
    if not high > low:
        return F.lit(0).cast("long")
    share = (value - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.coalesce(F.floor(share * F.lit(float(LIMIT))), F.lit(0)).cast("long")


def metadata(docs: DataFrame) -> DataFrame:
    """``doc_id``, byte size and hashes of each document; nulls in any column are accepted."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(OVERHEAD)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))

    def named(column: str) -> Column:
        return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")).bitwiseAND(F.lit(LIMIT))

    columns = [F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), crc.alias("text_crc32")]
    for name in ("source", "lang"):
        known = name in docs.columns
        columns.append((named(name) if known else F.lit(0).cast("long")).alias(f"axis_{name}"))
    return docs.select(*columns)


def coordinates(meta: DataFrame) -> DataFrame:
    """Metadata with one 24-bit coordinate per dimension and the hash that orders equal ones."""
    span = meta.agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.min("size").alias("c"), F.max("size").alias("d")
    ).first()
    tie = F.xxhash64("doc_id", "text_crc32", "size").bitwiseAND(F.lit(LIMIT))
    return meta.withColumns(
        {
            "axis_doc": _scaled(F.col("doc_id"), span["a"] or 0, span["b"] or 0),
            "axis_size": _scaled(F.log(F.col("size")), math.log(span["c"] or 1), math.log(span["d"] or 1)),
            "tie": tie,
        }
    )


AXES = ("axis_doc", "axis_size", "axis_source", "axis_lang")


def _key(axis: str) -> Column:
    """Order along a dimension: its coordinate, then the hash."""
    return F.shiftleft(F.col(axis).cast("long"), BITS) + F.col("tie")


def _leaf(node: Node, value) -> Column:
    """The tree as one expression; ``value`` gives what a leaf returns."""
    if node.low is None:
        return F.lit(value(node))
    return F.when(_key(node.axis) <= F.lit(node.cut), _leaf(node.low, value)).otherwise(_leaf(node.high, value))


def _cut_points(points: DataFrame, nodes: dict[int, Node], weights: dict[int, int], leaf_bytes: float) -> None:
    """Set ``cut`` of every node at the weighted share of its left shards."""
    spark = points.sparkSession
    key = F.lit(None).cast("long")
    for i, node in nodes.items():
        key = F.when(F.col("_node") == i, _key(node.axis)).otherwise(key)
    keyed = points.select("_node", "size", key.alias("_key"))
    state = {i: (0, 0, weights[i] * (n.shards // 2) / n.shards) for i, n in nodes.items()}
    for shift in range(2 * BITS - STEP, -1, -STEP):
        rows = [(i, prefix, float(target - before)) for i, (prefix, before, target) in state.items()]
        # One row per node of a level: fewer than the number of shards.
        wanted = F.broadcast(spark.createDataFrame(rows, "_node int, _prefix long, _target double"))
        near = keyed.join(wanted, "_node").filter(F.shiftright("_key", shift + STEP) == F.col("_prefix"))
        bins = near.groupBy("_node", "_target", F.shiftright("_key", shift).alias("_bin"))
        bins = bins.agg(F.sum("size").alias("_sum"), F.count("*").alias("_rows"))
        # At most 65,536 bins per node are put in order.
        upto = F.sum("_sum").over(Window.partitionBy("_node").orderBy("_bin"))
        hit = bins.withColumn("_upto", upto).filter(F.col("_upto") >= F.col("_target"))
        found = hit.groupBy("_node").agg(F.min(F.struct("_bin", "_upto", "_sum", "_rows")).alias("_hit")).collect()
        done = True
        for row in found:
            prefix, upto_bytes, inside, rows_inside = row["_hit"]
            _, before, target = state[row["_node"]]
            over = before + upto_bytes - target
            # The border of the bin that is nearer to the target.
            end = ((prefix + 1) << shift) - 1
            nodes[row["_node"]].cut = end if over <= inside - over else (prefix << shift) - 1
            state[row["_node"]] = (prefix, before + upto_bytes - inside, target)
            done &= rows_inside == 1 or inside <= TOLERANCE * leaf_bytes
        if done:
            break


def grow_tree(points: DataFrame, shards: int) -> Node:
    """The tree over points with coordinates, ``tie`` and ``size``."""
    root = Node(0, shards, 0)
    level, leaf_bytes = {0: root} if shards > 1 else {}, None
    while level:
        here = points.withColumn("_node", _leaf(root, lambda n: n.index)).filter(F.col("_node").isin(list(level)))
        spans = [F.sum("size").alias("bytes")]
        spans += [(F.max(a) - F.min(a)).alias(a) for a in AXES]
        rows = {r["_node"]: r for r in here.groupBy("_node").agg(*spans).collect()}
        if leaf_bytes is None:
            leaf_bytes = sum(r["bytes"] for r in rows.values()) / shards
        for i, node in level.items():
            node.axis = max(AXES, key=lambda a: rows[i][a]) if i in rows else AXES[0]
            node.cut = LIMIT << BITS
        _cut_points(here, {i: n for i, n in level.items() if i in rows}, {i: r["bytes"] for i, r in rows.items()}, leaf_bytes)
        following = {}
        for i, node in level.items():
            left = node.shards // 2
            node.low = Node(node.first, left, 2 * i + 1)
            node.high = Node(node.first + left, node.shards - left, 2 * i + 2)
            following |= {n.index: n for n in (node.low, node.high) if n.shards > 1}
        level = following
    return root


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Every document with its size, its shard and its place there, gapless from 0.

    Any column may be null: a null text has no bytes, a null number or name is the lowest
    coordinate. Rows alike in ``doc_id``, text hash and size share one point and so one shard;
    all others can be told apart. An empty table gives no rows. Of the input, ``doc_id, text``
    and, where they exist, ``source, lang`` are read; other columns are dropped.
    """
    points = coordinates(materialise(metadata(docs), "metadata"))
    tree = grow_tree(points, shards)
    placed = points.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), _leaf(tree, lambda n: n.first).cast("int").alias("shard")
    )
    numbered = number_rows(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot")
    return numbered.withColumn("grown_shard", F.lit(None).cast("int"))
