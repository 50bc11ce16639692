"""Shards: balance, gapless slots and odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocast.llm import kdshard
from aerocast.llm.numbering import number_rows
from tests.llm.awkward import documents, empty_documents


@pytest.fixture(scope="module")
def uneven(spark):
    """Half of the rows share a source, a third share a text, sizes span three orders."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(4000):
        text = "same text" if i % 3 == 0 else "x" * int(10 ** rng.uniform(1, 4))
        rows.append((i, text, "s0" if i % 2 else f"s{i % 17}", "en"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(5)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_bytes_are_near_equal(uneven, shards):
    out = kdshard.shard_documents(uneven, shards).toPandas()
    assert len(out) == 4000 and sorted(out["shard"].unique()) == list(range(shards))
    sizes = out.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 0.02 * sizes.mean() + 2 * out["size"].max()
    for _, rows in out.groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    assert out.grown_shard.isna().all() and (out.law == "bytes").all()


def test_cells_are_boxes(uneven):
    """Rows of one shard fill a box of the tree: the same rows give the same shards however they are partitioned."""
    one = kdshard.shard_documents(uneven, 8).select("doc_id", "shard")
    two = kdshard.shard_documents(uneven.repartition(11), 8).select("doc_id", "shard")
    assert one.exceptAll(two).isEmpty()


def slow_tree(points, shards, first=0):
    """Shard of every point by a plain recursion: sort along the widest dimension, cut next to the weighted share."""
    if shards == 1 or not len(points):
        return {p: first for p in points.index}
    axis = max(kdshard.AXES, key=lambda a: points[a].max() - points[a].min())
    key = points[axis].to_numpy().astype(np.int64) * 2**24 + points.tie.to_numpy()
    left = shards // 2
    target = points["size"].sum() * left / shards
    cut, before = None, 0
    for k in np.unique(key):
        here = points["size"].to_numpy()[key == k].sum()
        if before + here >= target:
            cut = k if before + here - target <= target - before else k - 1
            break
        before += here
    low = key <= cut
    return {**slow_tree(points[low], left, first), **slow_tree(points[~low], shards - left, first + left)}


@pytest.mark.parametrize("shards", [2, 5, 12])
def test_same_tree_as_a_plain_recursion(uneven, shards, monkeypatch):
    monkeypatch.setattr(kdshard, "TOLERANCE", 0)
    rows = uneven.filter("doc_id < 700")
    out = kdshard.shard_documents(rows, shards).toPandas().set_index("doc_id")["shard"].to_dict()
    points = kdshard.coordinates(kdshard.metadata(rows)).toPandas().set_index("doc_id")
    assert out == slow_tree(points, shards)


def test_odd_rows(spark):
    docs = documents(spark)
    out = kdshard.shard_documents(docs, 4).toPandas()
    assert len(out) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in out.itertuples():
        text = texts[None if np.isnan(r.doc_id) else int(r.doc_id)].encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    assert kdshard.shard_documents(empty_documents(spark), 4).count() == 0
    only = docs.select("doc_id", "text").filter("doc_id = 3")
    assert kdshard.shard_documents(only, 3).count() == 1


def test_native_plan(uneven):
    plan = kdshard.shard_documents(uneven, 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("buckets", [1, 5, None])
def test_gapless_numbers(spark, buckets):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 5).alias("k"), (F.col("id") % 50).alias("o"))
    out = number_rows(df, ["k"], ["o"], "n", buckets).toPandas()
    for _, rows in out.groupby("k"):
        assert sorted(rows.n) == list(range(len(rows)))
