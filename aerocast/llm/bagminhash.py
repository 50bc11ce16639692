"""Near-duplicate texts by BagMinHash over multisets of word shingles.

A text is the multiset of its runs of five words. For every shingle, points of Poisson processes
arrive on the weight axis, cut at the powers of two; a point counts when it lies below the
shingle's weight and takes one register if it is the earliest there. Two texts then agree in a
register with the probability of their weighted Jaccard similarity. A process is followed only
until it is later than the latest register, so a text costs little more than its length.

Registers are grouped into bands; texts that share a band are candidates. Texts with equal
multisets are one class from the start. Classes that are connected through shared bands form a
cluster, found without listing pairs. Inside a cluster whole texts are compared exactly: a large
cluster is cut into blocks, each pair of blocks is one task, and a task gives the overlaps of all
its texts as matrix products and returns only which of them belong together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.components import connected_components
from aerocast.llm.identity import ids_of, renumber, restore, text_numbers
from aerocast.llm.words import Words, chunks, free_name, mix, shingle_hashes, slices, split_words
from aerocast.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 36
ROWS = 6
#: Texts of one side of a comparison, and columns of one matrix product.
BLOCK = 256
COLUMNS = 4096
_STEP = 0x9E3779B97F4A7C15
_A, _B, _C = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def shingles_of(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of all shingles in the order of the texts.

    A text with fewer words than a shingle has one, of all its words; one without words has none.
    """
    hashes, owner = words.hashes(), words.text_of
    runs = shingle_hashes(hashes, size)
    inside = owner[: len(runs)] == owner[size - 1 :][: len(runs)] if len(runs) else np.zeros(0, bool)
    lengths = np.diff(words.first)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    found, texts = runs[inside], owner[: len(runs)][inside]
    if not len(short):
        return found, texts
    extra = [shingle_hashes(hashes[words.first[t] : words.first[t + 1]], int(lengths[t]))[0] for t in short]
    found, texts = np.concatenate((found, np.array(extra, np.uint64))), np.concatenate((texts, short))
    order = np.argsort(texts, kind="stable")
    return found[order], texts[order]


def _times(a: int, b: int) -> np.uint64:
    return np.uint64(a * b % 2**64)


def _weighted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, text) with their counts."""
    keys = hashes ^ mix(owner.astype(np.uint64) + _C)
    _, first, weights = np.unique(keys, return_index=True, return_counts=True)
    return hashes[first], owner[first], weights


def bag_min_hash(hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Signatures of ``n`` weighted sets: in every register the id of the earliest point."""
    seeds, texts, low, width, limit = [mix(hashes + _A)], [owner], [np.zeros(len(hashes))], [np.ones(len(hashes))], [weights]
    power = 1
    while len(weights) and weights.max() > power:
        heavy = np.flatnonzero(weights > power)
        seeds.append(mix(hashes[heavy] + _times(int(_B), power)))
        texts.append(owner[heavy])
        low.append(np.full(len(heavy), float(power)))
        width.append(np.full(len(heavy), float(power)))
        limit.append(weights[heavy])
        power *= 2
    seeds, texts, low, width, limit = (np.concatenate(x) for x in (seeds, texts, low, width, limit))
    times, ids = np.full(n * registers, np.inf), np.zeros(n * registers, np.uint64)
    now, count, latest = np.zeros(len(seeds)), 0, np.full(n, np.inf)
    while len(seeds):
        count += 1
        points = mix(seeds + _times(_STEP, count))
        now = now - np.log(((points >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
        draws = mix(points ^ _C)
        register = ((draws >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        height = low + width * ((draws & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32)
        valid = np.flatnonzero(height < limit)
        cells = texts[valid] * registers + register[valid]
        np.minimum.at(times, cells, now[valid])
        earliest = now[valid] == times[cells]
        ids[cells[earliest]] = points[valid[earliest]]
        here = np.flatnonzero(np.bincount(texts, minlength=n))
        latest[here] = times.reshape(n, registers)[here].max(1)
        going = now <= latest[texts]
        seeds, texts, low, width, limit, now = (x[going] for x in (seeds, texts, low, width, limit, now))
    return ids.reshape(n, registers)


def _totals(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return sums[borders[1:]] - sums[borders[:-1]]


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, a 128-bit key of the shingle multiset, its size and one hash per band."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                n = part.stop - part.start
                hashes, owner = shingles_of(split_words(texts[part]))
                borders = np.searchsorted(owner, np.arange(n + 1))
                sizes = np.diff(borders)
                full = np.flatnonzero(sizes)
                place = np.cumsum(sizes > 0) - 1
                found = bag_min_hash(*_weighted(hashes, place[owner]), len(full), bands * rows)
                band = np.empty((len(full), bands), np.uint64)
                for b in range(bands):
                    value = np.full(len(full), b + 1, np.uint64)
                    for r in range(rows):
                        value = mix(value + found[:, b * rows + r])
                    band[:, b] = value
                offsets = np.concatenate(([0], np.cumsum((sizes > 0) * bands))).astype(np.int32)
                columns = [
                    batch.column(0)[part.start : part.stop],
                    pa.array(_totals(mix(hashes ^ _A), borders).view(np.int64)),
                    pa.array(_totals(mix(hashes ^ _B), borders).view(np.int64)),
                    pa.array(sizes.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.ravel().view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "k1", "k2", "size", "bands"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(sign, "doc_id long, k1 long, k2 long, size long, bands array<long>")


def _occurrences(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, text, size of the text): the j-th occurrence of a shingle is a feature of its own."""
    hashes, owner = shingles_of(split_words(texts))
    keys = hashes ^ mix(owner.astype(np.uint64) + _C)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1])) if len(order) else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    number = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    features = mix(hashes[order] + mix(number.astype(np.uint64) + _A))
    return features, owner[order], np.bincount(owner, minlength=len(texts))


def overlaps(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the smaller weights for all pairs of texts, by matrix products, and the sizes of the multisets."""
    features, owner, sizes = _occurrences(texts)
    _, index, counts = np.unique(features, return_inverse=True, return_counts=True)
    shared = counts[index] > 1
    _, column = np.unique(index[shared], return_inverse=True)
    row = owner[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(texts), len(texts)), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (begin, begin + COLUMNS))
        part = np.zeros((len(texts), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - begin] = 1
        common += part @ part.T
    return common.astype(np.float64), sizes


def linked(texts: list[bytes | None], similarity: float) -> np.ndarray:
    """Which pairs of texts reach the weighted Jaccard similarity of their shingle multisets."""
    common, sizes = overlaps(texts)
    either = sizes[:, None] + sizes[None, :] - common
    return (common / np.maximum(either, 1) >= similarity) & (common > 0)


def _together(links: np.ndarray) -> np.ndarray:
    """Smallest index that each index is connected with."""
    least = np.arange(len(links))
    while True:
        near = np.where(links, least[None, :], len(links)).min(1, initial=len(links))
        now = np.minimum(least, near)
        now = now[now]
        if (now == least).all():
            return least
        least = now


def compare_clusters(clusters: DataFrame, docs: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that connect what belongs together, from clusters ``node, cluster``.

    Small clusters are compared several in one task, large ones in pairs of blocks.
    """
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # Stored, so that the rows of a large cluster can be split in the join.
    sized = clusters.join(materialise(sizes, "cluster-sizes"), "cluster")
    bins = max(1, clusters.count() // block)
    alone = F.col("blocks") == 1
    place = F.when(alone, F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int")
    task = F.when(alone, F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster"))
    dealt = sized.select("node", "cluster", "blocks", place.alias("block"), task.alias("task"))
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    # The ids grow with the data: texts meet them by a shuffle at every size.
    wanted = materialise(texts.join(dealt.hint("merge"), "node").dropDuplicates(["node"]), "texts")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = wanted.select("*", other).select(
        "node", "cluster", "text", "block", "task", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("blocks") > 1).alias("large"),
    )

    def compare(table: pa.Table) -> pa.Table:
        nodes, cluster = table.column("node").to_numpy(), table.column("cluster").to_numpy()
        order = np.argsort(nodes, kind="stable")
        texts = table.column("text").cast(pa.binary()).to_pylist()
        links = linked([texts[i] for i in order], similarity)
        links &= cluster[order][:, None] == cluster[order][None, :]
        least = _together(links)
        found = np.flatnonzero(least != np.arange(len(least)))
        a, b = nodes[order][least[found]], nodes[order][found]
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return met.groupBy("large", "task", "low", "high").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id, kept`` for every row: the smallest id of the group, and whether it is the row's own.

    Texts without words are no duplicates of anything; texts of less than five words are compared
    as wholes. Rows without an id have no class and are kept. Rows that repeat an id with one text
    are one document and share its fate; texts that share an id are judged one by one, and ``kept`` then tells
    whether a text comes first in its group. An empty table gives no rows; other columns are dropped.
    """
    numbers = text_numbers(docs)
    if numbers is None:
        return _classes(docs, similarity, bands, rows, block)
    numbered = materialise(renumber(docs, numbers)[0].select("doc_id", "text"), "numbered")
    return ids_of(_classes(numbered, similarity, bands, rows, block), numbers, ["doc_id", "class_id"])


def _classes(docs: DataFrame, similarity: float, bands: int, rows: int, block: int) -> DataFrame:
    """``near_duplicates`` where an id stands for one text."""
    signed = materialise(signatures(docs, bands, rows), "signatures")
    usable = signed.filter((F.col("size") > 0) & F.col("doc_id").isNotNull())
    classes = materialise(usable.groupBy("k1", "k2", "size").agg(F.min("doc_id").alias("node")), "classes")
    nodes = usable.join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    buckets = nodes.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    firsts = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    # Stored, so that the rows of a much shared bucket can be split in the join.
    firsts = materialise(firsts.filter(F.col("low") < F.col("high")).select("bucket", "low"), "buckets")
    stars = buckets.join(firsts, "bucket").filter(F.col("low") < F.col("node")).select("low", "node").distinct()
    clusters = connected_components(stars, "low", "node").withColumnRenamed("component", "cluster")
    links = compare_clusters(materialise(clusters, "clusters"), docs, similarity, block)
    groups = connected_components(materialise(links, "links"), "a", "b")

    known = classes.join(groups, "node", "left")
    known = known.select("k1", "k2", "size", F.coalesce("component", "node").alias("_class"))
    known = materialise(known, "classes")
    rows_out = signed.select("doc_id", "k1", "k2", "size").withColumn("usable", (F.col("size") > 0) & F.col("doc_id").isNotNull())
    keyed = rows_out.select("doc_id", *[F.when(F.col("usable"), F.col(k)).alias(k) for k in ("k1", "k2", "size")])
    joined = keyed.join(known, ["k1", "k2", "size"], "left")
    found = F.coalesce("_class", "doc_id")
    return joined.select("doc_id", found.alias("class_id"), F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows without an id or without words stay, as do rows that repeat the document kept; of texts that share an
    id, those go that are no first of their group. An empty table gives no rows.
    """
    numbers = text_numbers(docs)
    if numbers is not None:
        numbered, own = renumber(docs, numbers)
        return restore(_drop(materialise(numbered, "numbered"), **options), docs, own)
    return _drop(docs, **options)


def _drop(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """``drop_near_duplicates`` where an id stands for one text."""
    found = materialise(_classes(docs, similarity, bands, rows, block), "duplicates")
    own = free_name("_gone", docs.columns)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias(own)).distinct()
    # The ids grow with the data: texts meet them by a shuffle at every size.
    return docs.join(gone.hint("merge"), F.col("doc_id").cast("long") == F.col(own), "left_anti")
