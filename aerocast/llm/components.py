"""Connected components of links, without links or components on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.session import materialise


def _minima(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Smallest neighbour of every node, stored: the join after it can then split a hub's rows."""
    return materialise(edges.groupBy(node).agg(F.min(other).alias("_least")), "minima")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of the links: the smallest node that it can reach.

    Alternates the large-star and small-star steps until the links no longer change. Each step
    attaches neighbours to the smallest one, so a long chain needs a logarithmic number of rounds.
    Every round is stored in the shared folder. Null ends and loops are ignored.
    """
    ends = edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    current = ends.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("high") != F.col("low"))).distinct()
    current, before = materialise(current, "links"), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = current.select(F.col("high").alias("u"), F.col("low").alias("v"))
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minima(both, "u", "v"), "u").filter(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("high"), F.least("u", "_least").alias("low")).distinct()
        large = materialise(large, "links")
        small = large.join(_minima(large, "high", "low"), "high")
        own = small.select("high", F.col("_least").alias("low"))
        other = small.filter(F.col("low") != F.col("_least")).select(F.col("low").alias("high"), F.col("_least").alias("low"))
        current = materialise(own.unionByName(other).distinct(), "links")
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return current.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)
