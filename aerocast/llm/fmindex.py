"""Benchmark decontamination by an FM-index per shard of the training texts.

A shard is a run of whole documents. Its words are numbered by their place in the sorted list of the
shard's distinct words, every document ends with a mark of its own, and all suffixes are sorted. The
index keeps the word before each suffix in a wavelet matrix, where each suffix of every
``STEP``-th place starts, and nothing of the text. A window of a benchmark item is found backwards,
word by word, from two ranks a word; places come from walks to the next sampled suffix.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.words import CHUNK_BYTES, chunks, slices, split_words
from aerocast.session import materialise

WINDOW = 10
#: Words and documents of a shard; a longer document is a shard by itself.
SHARD_WORDS = 1 << 19
#: Every such place of a text is sampled.
STEP = 16
#: Benchmark text that is searched for at once.
BLOCK_BYTES = 32 << 20
#: Suffixes that are walked to their places at once.
HELD_ROWS = 1 << 18
#: Everything but digits, letters and bytes beyond ASCII ends a word.
SEPARATORS = np.arange(256) < 0x80
SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

#: Arrays of a stored index: little-endian values of these kinds, as binary columns.
_ARRAYS = {"first": "<i4", "symbols": "<u8", "heads": "<i4", "bits": "<u8", "zeros": "<i4", "marks": "<u8", "samples": "<i4"}
INDEX = "shard string, doc_ids array<long>, words long, " + ", ".join(f"{name} binary" for name in _ARRAYS)
FOUND = "shard string, doc_no int, doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"


class Bits:
    """A bit vector with ranks: words of 64 bits and the ones before each word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @staticmethod
    def pack(flags: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(flags) // 64 + 1) * 64, np.uint8)
        padded[: len(flags)] = flags
        return np.packbits(padded, bitorder="little").view("<u8")

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place ``i``."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & below)


class Wavelet:
    """A wavelet matrix: one bit vector per bit of the symbols, the highest first."""

    def __init__(self, levels: list[Bits], zeros: np.ndarray):
        self.levels, self.zeros = levels, zeros

    @staticmethod
    def pack(symbols: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of all levels and the number of zero bits on each."""
        bits, zeros = [], []
        for level in range(width - 1, -1, -1):
            flags = (symbols >> level) & 1 != 0
            bits.append(Bits.pack(flags))
            zeros.append(len(flags) - int(flags.sum()))
            symbols = np.concatenate((symbols[~flags], symbols[flags]))
        return np.concatenate(bits), np.array(zeros, np.int32)

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """For each pair, how often the symbol stands before place ``i``."""
        begin = np.zeros(len(i), np.int64)
        top = len(self.levels) - 1
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbols >> (top - level)) & 1 != 0
            for place in (begin, i := i.copy()):
                ones = bits.rank(place)
                place[:] = np.where(one, zeros + ones, place - ones)
        return i - begin

    def step(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it stands before."""
        begin, i, symbol = np.zeros(len(i), np.int64), i.copy(), np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.levels, self.zeros):
            one = bits.at(i)
            symbol = symbol * 2 + one
            for place in (begin, i):
                ones = bits.rank(place)
                place[:] = np.where(one, zeros + ones, place - ones)
        return symbol, i - begin


def sort_suffixes(text: np.ndarray, size: int) -> np.ndarray:
    """Places of all suffixes in order; ``text`` holds numbers below ``size`` and ends with one that occurs once.

    Ranks by three symbols come first, then the compared length doubles; only suffixes that share their
    rank are sorted again.
    """
    n = len(text)
    padded = np.concatenate((text.astype(np.int64), np.zeros(2, np.int64)))
    if size < 1 << 21:
        depth, key = 3, (padded[:n] * size + padded[1 : n + 1]) * size + padded[2:]
    else:
        depth, key = 2, padded[:n] * size + padded[1 : n + 1]
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    held, key = order, key[order]
    places = np.arange(n)
    while len(held):
        new = np.concatenate(([True], key[1:] != key[:-1]))
        group = places[np.maximum.accumulate(np.where(new, np.arange(len(held)), 0))]
        rank[held] = group
        order[places] = held
        # A suffix alone in its group has its final place.
        shared = ~(new & np.append(new[1:], True))
        held, places = held[shared], places[shared]
        key = rank[held] * n + rank[np.minimum(held + depth, n - 1)]
        again = np.argsort(key)
        held, key = held[again], key[again]
        depth *= 2
    return order


def index_shard(hashes: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of the index of documents given by word hashes and the first word of each, then the total.

    ``heads[s]`` counts the suffixes that begin with a smaller symbol; symbol 0 is the end of a document.
    """
    documents, n = len(first) - 1, len(hashes) + len(first) - 1
    symbols, number = np.unique(hashes, return_inverse=True)
    # Ends of documents are all different while suffixes are sorted, and one symbol afterwards.
    at_end = np.zeros(n, bool)
    at_end[first[1:] + np.arange(documents)] = True
    text = np.empty(n, np.int64)
    text[at_end], text[~at_end] = np.arange(documents), number + documents
    order = sort_suffixes(text, documents + len(symbols))
    plain = np.maximum(text - documents + 1, 0)
    heads = np.concatenate(([0], np.cumsum(np.bincount(plain, minlength=len(symbols) + 1))))
    bits, zeros = Wavelet.pack(plain[order - 1], max(1, int(len(symbols)).bit_length()))
    begins = np.zeros(n, bool)
    begins[first[:-1] + np.arange(documents)] = True
    begins[::STEP] = True
    marks = begins[order]
    return {
        "first": first,
        "symbols": symbols,
        "heads": heads,
        "bits": bits,
        "zeros": zeros,
        "marks": Bits.pack(marks),
        "samples": order[marks],
    }


class Index:
    """One shard's index, ready for search."""

    def __init__(self, words: int, arrays: dict[str, bytes]):
        views = {name: np.frombuffer(arrays[name], kind) for name, kind in _ARRAYS.items()}
        self.first, self.symbols, self.zeros = views["first"].astype(np.int64), views["symbols"], views["zeros"]
        self.heads, self.samples = views["heads"].astype(np.int64), views["samples"].astype(np.int64)
        self.words, self.size = words, words + len(self.first) - 1
        each = self.size // 64 + 1
        self.text = Wavelet([Bits(views["bits"][i * each : (i + 1) * each]) for i in range(len(self.zeros))], self.zeros)
        self.marks = Bits(views["marks"])

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, and the range of suffixes that begin with each.

        A row of ``phrases`` ends with the hashes of its words; ``lengths`` says how many there are.
        """
        empty = np.zeros(0, np.int64)
        if not len(self.symbols) or not len(phrases):
            return empty, empty, empty
        at = np.minimum(np.searchsorted(self.symbols, phrases), len(self.symbols) - 1)
        width = phrases.shape[1]
        used = np.arange(width)[None, :] >= width - lengths[:, None]
        alive = np.flatnonzero(((self.symbols[at] == phrases) | ~used).all(1))
        number = at + 1
        last = number[alive, -1]
        low, high = self.heads[last], self.heads[last + 1]
        for back in range(2, width + 1):
            go = np.flatnonzero(lengths[alive] >= back)
            if not len(go):
                break
            symbol = number[alive[go], -back]
            low[go] = self.heads[symbol] + self.text.rank(symbol, low[go])
            high[go] = self.heads[symbol] + self.text.rank(symbol, high[go])
            there = low < high
            alive, low, high = alive[there], low[there], high[there]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the shard's text, ends of documents included, of each suffix."""
        places, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        waiting, rows = np.arange(len(rows)), rows.copy()
        while len(waiting):
            marked = self.marks.at(rows)
            done = waiting[marked]
            places[done] = self.samples[self.marks.rank(rows[marked])] + steps[done]
            waiting, rows = waiting[~marked], rows[~marked]
            symbol, before = self.text.step(rows)
            rows = self.heads[symbol] + before
            steps[waiting] += 1
        return places

    def occurrences(self, phrases: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Phrase, document and first word in the shard of every occurrence, some at a time."""
        phrase, low, high = self.search(phrases, lengths)
        counts = high - low
        ends = np.cumsum(counts)
        for begin in range(0, int(ends[-1]) if len(ends) else 0, HELD_ROWS):
            wanted = np.arange(begin, min(begin + HELD_ROWS, int(ends[-1])))
            which = np.searchsorted(ends, wanted, side="right")
            places = self.locate(low[which] + wanted - (ends - counts)[which])
            document = np.searchsorted(self.first + np.arange(len(self.first)), places, side="right") - 1
            yield phrase[which], document, places - document


def index_documents(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard of ``doc_id, text``: its documents and the arrays of its index.

    Shards are runs of rows of one partition, so nothing is shuffled. Null and empty texts have no words; rows
    without an id and rows that repeat one are documents like others. Words are lower-cased (A-Z) and
    known by 64-bit hashes. Other columns are dropped; an empty table gives no shards.
    """

    def record(ids: list[pa.Array], hashes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        first = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
        arrays = index_shard(np.concatenate(hashes), first)
        doc_ids = pa.concat_arrays(ids)
        lists = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
        packed = [pa.array([arrays[name].astype(kind).tobytes()], pa.binary()) for name, kind in _ARRAYS.items()]
        columns = [pa.array([uuid.uuid4().hex]), lists, pa.array([int(first[-1])]), *packed]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "doc_ids", "words", *_ARRAYS])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, counts, size = [], [], [], 0
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts, min(CHUNK_BYTES, 4 * shard_words)):
                words = split_words(texts[part], SEPARATORS, lower=True)
                more = len(words.starts) + len(words.first) - 1
                if ids and size + more > shard_words:
                    yield record(ids, hashes, counts)
                    ids, hashes, counts, size = [], [], [], 0
                size += more
                ids.append(batch.column(0)[part.start : part.stop])
                hashes.append(words.hashes())
                counts.append(np.diff(words.first))
        if ids:
            yield record(ids, hashes, counts)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(build, INDEX)


class Phrases:
    """The distinct windows of benchmark items, and the items that hold each."""

    def __init__(self, items: list[str | None], texts: list[bytes | None], window: int = WINDOW):
        self.window = window
        rows, lengths, owners = [], [], []
        for part in chunks(texts):
            words = split_words(texts[part], SEPARATORS, lower=True)
            hashes = words.hashes()
            counts = np.diff(words.first)
            short = np.flatnonzero((counts > 0) & (counts < window))
            rows.extend(np.concatenate((np.zeros(window - counts[i], np.uint64), hashes[words.first[i] : words.first[i + 1]]))[None] for i in short)
            lengths.append(counts[short])
            owners.append(short + part.start)
            if len(hashes) >= window:
                owner = words.text_of
                begins = np.flatnonzero(owner[: len(owner) - window + 1] == owner[window - 1 :])
                rows.append(hashes[begins[:, None] + np.arange(window)])
                lengths.append(np.full(len(begins), window))
                owners.append(owner[begins] + part.start)
        whole = np.concatenate([np.zeros((0, window), np.uint64), *rows])
        keyed = np.column_stack((np.concatenate([np.zeros(0, np.uint64), *lengths]).astype(np.uint64), whole))
        distinct, number = np.unique(keyed, axis=0, return_inverse=True)
        self.hashes, self.lengths = np.ascontiguousarray(distinct[:, 1:]), distinct[:, 0].astype(np.int64)
        names, ids = np.unique([i for i in items if i is not None] or np.zeros(0, "U1"), return_inverse=True)
        self.names = names.tolist()
        item = np.full(len(items), -1)
        item[[i for i, x in enumerate(items) if x is not None]] = ids
        pairs = np.column_stack((number.reshape(-1), item[np.concatenate([np.zeros(0, np.int64), *owners])]))
        pairs = np.unique(pairs[pairs[:, 1] >= 0], axis=0)
        self.item = pairs[:, 1]
        self.begin = np.searchsorted(pairs[:, 0], np.arange(len(self.hashes) + 1))

    def items_of(self, phrase: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, item) of occurrences, in order."""
        both = np.unique(np.column_stack((document, phrase)), axis=0)
        counts = (self.begin[1:] - self.begin[:-1])[both[:, 1]]
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        found = np.column_stack((np.repeat(both[:, 0], counts), self.item[np.repeat(self.begin[:-1][both[:, 1]], counts) + offset]))
        found = np.unique(found, axis=0)
        return found[:, 0], found[:, 1]


def _lists(owner: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """One list per owner 0..n-1 of values sorted by owner."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), values)


def _search_shard(shard: str, doc_ids: pa.Array, index: Index, phrases: Phrases) -> pa.RecordBatch:
    n = len(doc_ids)
    edges = np.zeros(index.words + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for phrase, document, start in index.occurrences(phrases.hashes, phrases.lengths):
        np.add.at(edges, start, 1)
        np.add.at(edges, start + phrases.lengths[phrase], -1)
        pairs.append(np.column_stack(phrases.items_of(phrase, document)))
    hit = np.cumsum(edges[:-1]) > 0
    owner = np.repeat(np.arange(n), np.diff(index.first))
    change = np.concatenate(([True], (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1]), [True])) if index.words else np.zeros(0, bool)
    borders = np.flatnonzero(change)
    runs = np.flatnonzero(hit[borders[:-1]]) if len(borders) else np.zeros(0, np.int64)
    starts, ends = borders[runs], borders[runs + 1] if len(runs) else np.zeros(0, np.int64)
    of = owner[starts]
    spans = pa.StructArray.from_arrays(
        [pa.array((x - index.first[of]).astype(np.int32)) for x in (starts, ends)], names=["start", "end"]
    )
    found = np.unique(np.concatenate(pairs), axis=0)
    items = pa.array(phrases.names, pa.string()).take(pa.array(found[:, 1]))
    columns = [
        pa.array([shard] * n, pa.string()),
        pa.array(np.arange(n, dtype=np.int32)),
        doc_ids,
        pa.array(np.diff(index.first)),
        _lists(of, spans, n),
        _lists(found[:, 0], items, n),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "doc_no", "doc_id", "n_words", "spans", "items"])


def search_index(index: DataFrame, items: list[str | None], texts: list[bytes | None], window: int = WINDOW) -> DataFrame:
    """FOUND for every document of the index: merged spans of hit words, and the items found."""
    phrases = index.sparkSession.sparkContext.broadcast(Phrases(items, texts, window))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                ids = row["doc_ids"].values
                shard = Index(row["words"].as_py(), {name: row[name].as_py() for name in _ARRAYS})
                whole = _search_shard(row["shard"].as_py(), ids, shard, phrases.value)
                yield from (whole.slice(b, 1024) for b in range(0, whole.num_rows, 1024))

    return index.mapInArrow(search, FOUND)


def _merge(parts: DataFrame) -> DataFrame:
    """FOUND from lists of spans that may overlap: sorted, and joined where they touch."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spans")
            owner, flat = np.asarray(pc.list_parent_indices(lists)), lists.flatten()
            starts, ends = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            # Documents lie behind one another, so that a running maximum of ends stays within each.
            room = int(ends.max(initial=0)) + 1
            order = np.lexsort((starts, owner))
            owner, starts, ends = owner[order], (starts + owner * room)[order], (ends + owner * room)[order]
            reach = np.maximum.accumulate(ends)
            new = np.concatenate(([True], (starts[1:] > reach[:-1]) | (owner[1:] != owner[:-1])))[: len(starts)]
            heads = np.flatnonzero(new)
            last = np.append(heads[1:], len(starts))[: len(heads)] - 1
            of = owner[heads]
            values = [(starts[heads] - of * room).astype(np.int32), (reach[last] - of * room).astype(np.int32)]
            spans = pa.StructArray.from_arrays([pa.array(v) for v in values], names=["start", "end"])
            i = batch.schema.get_field_index("spans")
            yield batch.set_column(i, "spans", _lists(of, spans, batch.num_rows))

    return parts.mapInArrow(merge, FOUND)


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row of ``doc_id, text``.

    ``spans`` are the runs of words (from, to before) that lie in any occurrence of ``window`` words of a
    benchmark text; a text of fewer words, but at least one, is searched for as a whole. ``items`` are the
    distinct ``item_id`` values, as strings, that occur. Items without an id hit words but are not listed;
    rows that repeat an id add their windows to it. Null texts have no words. Repeated documents give repeated
    rows, empty tables none (documents) or no spans (benchmark); other columns of either are dropped.

    The benchmark reaches the workers in blocks of about ``block_bytes``; with more than one, the index is stored
    once in the shared folder and searched block by block.
    """
    index = index_documents(docs)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    if blocks > 1:
        index = materialise(index, "fm-index")
    parts = []
    for i in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).toArrow()
        parts.append(search_index(index, block["item_id"].to_pylist(), block["text"].cast(pa.binary()).to_pylist(), window))
    found = parts[0]
    if blocks > 1:
        for part in parts[1:]:
            found = found.union(part)
        # One row of each block for a document, so no group grows with the documents.
        found = _merge(
            found.groupBy("shard", "doc_no", "doc_id", "n_words").agg(
                F.flatten(F.collect_list("spans")).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            )
        )
    return found.select("doc_id", "n_words", "spans", "items")
