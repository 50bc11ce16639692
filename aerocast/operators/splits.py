"""Train / validation splits by time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.contract import TRAIN_CUTOFF, ContractError
from aerocast.operators.ordered import time_percentile


def mark_split(df: DataFrame, cutoff: str = TRAIN_CUTOFF) -> DataFrame:
    """Add ``split``: train up to and including the cutoff, val after it."""
    old = F.col("datetime") <= F.lit(cutoff).cast("timestamp_ntz")
    return df.withColumn("split", F.when(old, F.lit("train")).otherwise(F.lit("val")))


def mark_quantile_split(df: DataFrame, share: float = 0.8) -> DataFrame:
    """Add ``split`` with the cutoff at a quantile of the row times."""
    cutoff = time_percentile(df, share).scalar()
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("datetime"))
    return df.withColumn("split", F.when(micros <= cutoff, F.lit("train")).otherwise(F.lit("val")))


def split_counts(marked: DataFrame) -> dict[str, int]:
    """Rows per split; an empty side is an error."""
    counts = {r["split"]: r["n"] for r in marked.groupBy("split").agg(F.count("*").alias("n")).collect()}
    for side in ("train", "val"):
        if not counts.get(side):
            raise ContractError(f"no rows on the {side} side of the cutoff")
    return counts


def train_val(df: DataFrame, cutoff: str = TRAIN_CUTOFF) -> tuple[DataFrame, DataFrame]:
    """The two sides as frames; both must have rows."""
    split_counts(mark_split(df, cutoff))
    at = F.lit(cutoff).cast("timestamp_ntz")
    return df.filter(F.col("datetime") <= at), df.filter(F.col("datetime") > at)
