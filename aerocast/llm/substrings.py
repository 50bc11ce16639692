"""Substring dedup by seed and extend on winnowed anchors.

A window is ``LENGTH`` consecutive words. Its anchor is the smallest hash among its runs of
``SEED`` words, the leftmost of equal ones, so equal windows have equal anchors at equal places.
The windows of one anchor are neighbours: their words, extended both ways from the anchor as far as
it rules, are a block. Only anchors that occur more than once are followed.

* Blocks that are equal as wholes are matched by their hash: all but the first occurrence repeat.
* The first occurrences of different blocks with one anchor share some windows at most; these
  blocks, each once, are matched window by window.

A word goes if any window over it started earlier, so runs of repeated windows, over block borders
too, give maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.identity import ids_of, renumber, restore, text_numbers
from aerocast.llm.words import Words, chunks, free_name, mix, power_tables, shingle_hashes, slices, split_words
from aerocast.session import materialise

LENGTH = 20
SEED = 5
#: Distinct anchors that a counting task holds before it passes them on.
HELD_ANCHORS = 1_000_000


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per run of word hashes, from prefix sums of a polynomial."""
    powers, inverses = power_tables(len(values) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values) * powers[: len(values)])))
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


class Blocks:
    """All blocks of the texts of a chunk: owner, anchor hash and place, first window and number of windows."""

    def __init__(self, words: Words, length: int, seed: int):
        self.length, self.hashes = length, words.hashes()
        owner, n = words.text_of, max(0, len(self.hashes) - length + 1)
        seeds = shingle_hashes(self.hashes, seed)
        reach, least = length - seed + 1, seeds
        # Minima over ``reach`` neighbours: doubled runs, then two that overlap.
        run = 1
        while 2 * run <= reach:
            least = np.minimum(least[:-run], least[run:])
            run *= 2
        if run < reach:
            least = np.minimum(least[: run - reach], least[reach - run :])
        least = least[:n]
        place = np.zeros(n, np.int16)
        for j in range(reach - 1, -1, -1):
            place[seeds[j : j + n] == least] = j
        windows = np.flatnonzero(owner[:n] == owner[length - 1 :][:n])
        anchors = windows + place[windows]
        new = np.concatenate(([True], anchors[1:] != anchors[:-1])) if len(anchors) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        self.begin, self.count = windows[heads], np.diff(np.append(heads, len(windows)))
        self.at, self.owner = anchors[heads], owner[windows[heads]]
        self.anchor = seeds[self.at]
        self.first = words.first
        self.start = self.begin - words.first[self.owner]

    def contents(self, chosen: np.ndarray) -> np.ndarray:
        """Hash of all words under the windows of the chosen blocks."""
        begin = self.begin[chosen]
        return _spans(self.hashes, begin, begin + self.count[chosen] + self.length - 1)

    def windows(self, chosen: np.ndarray) -> np.ndarray:
        """Hashes of the windows of the chosen blocks, one block after the other."""
        counts = self.count[chosen]
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(self.begin[chosen], counts) + offset
        return _spans(self.hashes, starts, starts + self.length)


def _short(anchors: np.ndarray) -> np.ndarray:
    """The upper 48 bits as a long: enough to find repeated anchors, and smaller to shuffle."""
    return (anchors >> np.uint64(16)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def repeated_anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """``anchor`` for every anchor that occurs more than once."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        values, counts = (np.concatenate(x) for x in zip(*parts))
        distinct, index = np.unique(values, return_inverse=True)
        return distinct, np.bincount(index, counts, len(distinct)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches):
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                found = _short(Blocks(split_words(texts[part]), length, seed).anchor)
                held.append(merged([(found, np.ones(len(found), np.int64))]))
                if sum(len(h[0]) for h in held) > 2 * HELD_ANCHORS:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD_ANCHORS:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names=["anchor", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], names=["anchor", "n"])

    counted = _texts(docs).select("text").mapInArrow(count, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")


def anchor_places(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """``anchor, doc_id, place`` of every anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                blocks = Blocks(split_words(texts[part]), length, seed)
                ids = batch.column(0)[part.start : part.stop].take(pa.array(blocks.owner))
                place = (blocks.at - blocks.first[blocks.owner]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(_short(blocks.anchor)), ids, pa.array(place)], names=["anchor", "doc_id", "place"])

    known = _texts(docs).filter(F.col("doc_id").isNotNull())
    return known.mapInArrow(find, "anchor long, doc_id long, place int")


def repeated_blocks(docs: DataFrame, places: DataFrame, length: int, seed: int) -> DataFrame:
    """Blocks of the anchors listed in ``doc_id, places``; a task gives the windows of equal blocks once."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                blocks = Blocks(split_words(texts[part]), length, seed)
                lists = batch.column(2)[part.start : part.stop]
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                marked = np.zeros(len(blocks.hashes), bool)
                marked[blocks.first[owner] + lists.flatten().to_numpy()] = True
                chosen = np.flatnonzero(marked[blocks.at])
                contents = blocks.contents(chosen)
                _, once = np.unique(contents, return_index=True)
                once.sort()
                windows, counts = blocks.windows(chosen[once]), np.zeros(len(chosen), np.int64)
                counts[once] = blocks.count[chosen[once]]
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                absent = np.ones(len(chosen), bool)
                absent[once] = False
                columns = [
                    pa.array(blocks.anchor[chosen].view(np.int64)),
                    pa.array(contents.view(np.int64)),
                    batch.column(0)[part.start : part.stop].take(pa.array(blocks.owner[chosen])),
                    pa.array(blocks.start[chosen].astype(np.int32)),
                    pa.array(blocks.count[chosen].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(windows.view(np.int64)), mask=pa.array(absent)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "doc_id", "start", "n", "windows"])

    joined = _texts(docs).join(places, "doc_id").select("doc_id", "text", "places")
    kinds = "anchor long, content long, doc_id long, start int, n int, windows array<long>"
    return joined.mapInArrow(extend, kinds)


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``doc_id, spans`` for documents with repeats: first window of a block and a bit per repeated window.

    Documents are ordered by id. An id must stand for one text (see ``text_numbers``), whose rows are one document;
    rows without an id take no part. ``length - seed`` must be below 31.
    """
    repeated = materialise(repeated_anchors(docs, length, seed), "anchors")
    # The side of repeated anchors is stored, so that the rows of a frequent anchor can be split.
    places = anchor_places(docs, length, seed).join(repeated, "anchor").select("doc_id", "place")
    places = places.groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    blocks = materialise(repeated_blocks(docs, places, length, seed), "blocks")

    block = ["anchor", "content"]
    firsts = blocks.groupBy(*block).agg(F.min(F.struct("doc_id", "start")).alias("first"), F.any_value("windows", True).alias("windows"))
    firsts = materialise(firsts, "firsts")
    varied = firsts.groupBy("anchor").agg(F.count("*").alias("contents")).filter("contents > 1").select("anchor")
    varied = materialise(varied, "varied")
    each = firsts.join(varied, "anchor").select(*block, "first", F.posexplode("windows").alias("i", "window"))
    each = each.select(*block, "window", "i", F.struct(F.col("first.doc_id"), F.col("first.start") + F.col("i")).alias("at"))
    each = materialise(each, "windows")
    earliest = materialise(each.groupBy("anchor", "window").agg(F.min("at").alias("earliest")), "earliest")
    later = each.join(earliest, ["anchor", "window"]).filter(F.col("at") > F.col("earliest"))
    masks = later.groupBy(*block).agg(F.bit_or(F.expr("shiftleft(1, i)")).alias("mask"))
    known = materialise(firsts.drop("windows").join(masks, block, "left"), "known")

    is_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("start") == F.col("first.start"))
    bits = F.when(is_first, F.col("mask")).otherwise(F.expr("shiftleft(1, n) - 1"))
    cut = blocks.drop("windows").join(known, block).select("doc_id", "start", bits.alias("bits")).filter("bits > 0")
    return cut.groupBy("doc_id").agg(F.collect_set(F.struct("start", "bits")).alias("spans"))


def cut_texts(texts: list[bytes | None], spans: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(words, removed words, kept words joined by one space) of texts with the spans to remove."""
    n_words, n_removed, kept = [], [], []
    offsets = np.concatenate(([0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy())))
    flat = spans.flatten()
    starts, bits = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        words = (text or b"").split()
        n_words.append(len(words))
        if a == b:
            n_removed.append(0)
            kept.append(b" ".join(words))
            continue
        edges = np.zeros(len(words) + 1, np.int64)
        for i in range(length):
            begin = starts[a:b][(bits[a:b] >> i) & 1 == 1] + i
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + length, -1)
        gone = np.cumsum(edges[:-1]) > 0
        n_removed.append(int(gone.sum()))
        kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone)]))
    return np.array(n_words, np.int64), np.array(n_removed, np.int64), kept


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` with the words that no earlier window repeats, joined by one space.

    Windows are judged on the input. A null text has no words; a text shorter than a window loses
    none. Rows that repeat an id and a text are one document; texts that share an id are documents of their own, in
    the order of their hashes. An empty table gives no rows; other columns are dropped.
    """
    numbers = text_numbers(docs)
    if numbers is not None:
        numbered = materialise(renumber(docs, numbers)[0].select("doc_id", "text"), "numbered")
        return ids_of(_remove(numbered, length, seed), numbers, ["doc_id"])
    return _remove(docs, length, seed)


def _remove(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """``remove_repeats`` where an id stands for one text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                ids, spans = (batch.column(i)[part.start : part.stop] for i in (0, 2))
                n_words, n_removed, kept = cut_texts(texts[part], spans, length)
                columns = [ids, pa.array(n_words), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "text"])

    joined = _texts(docs).join(repeated_spans(docs, length, seed), "doc_id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, text string")


def replace_texts(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """The documents with all their columns: texts that lose words hold the others, all else is unchanged.

    Null, empty and short texts stay as they are, as do rows without an id; rows that share an id are as in
    ``remove_repeats``. Every row is returned, none of an empty table.
    """
    numbers = text_numbers(docs)
    if numbers is not None:
        numbered, own = renumber(docs, numbers)
        return restore(_replace(materialise(numbered, "numbered"), length, seed), docs, own)
    return _replace(docs, length, seed)


def _replace(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """``replace_texts`` where an id stands for one text."""
    names = docs.columns
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            out = list(texts)
            for part in chunks(texts):
                _, n_removed, kept = cut_texts(texts[part], batch.column(len(names))[part.start : part.stop], length)
                out[part] = [k if n else t for t, n, k in zip(texts[part], n_removed, kept)]
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    own_id, own_spans = free_name("_repeats_of", names), free_name("_repeats", names)
    found = repeated_spans(docs, length, seed)
    spans = found.select(F.col("doc_id").alias(own_id), F.col("spans").alias(own_spans))
    joined = docs.join(spans, F.col("doc_id").cast("long") == F.col(own_id), "left")
    return joined.select(*[f"`{c}`" for c in names], own_spans).mapInArrow(cut, docs.schema)
