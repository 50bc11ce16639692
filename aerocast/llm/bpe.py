"""Byte-level BPE by two tiers: a minimal perfect hash for whole pre-tokens, a heap for the rest.

A pre-token that is in the vocabulary is found with one look-up in a minimal perfect hash and
compared byte for byte. Any other pre-token starts as a linked list of its bytes; the pair with
the smallest rank, the leftmost first, is taken from a heap and merged until no pair is left.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.words import chunks, hash_items, mix, slices

#: Pre-tokens whose ids a worker remembers; beyond it the memory is emptied, results stay the same.
MEMORY = 300_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class PerfectHash:
    """Hash and displace: every key of a fixed list has a slot of its own, without empty slots."""

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        hashes = hash_items(keys)
        self.buckets = max(1, self.n // 4)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        begins = np.concatenate(([0], np.cumsum(sizes)))
        self.shift = np.zeros(self.buckets, np.int64)
        self.key_at = np.zeros(self.n, np.int64)
        free = np.ones(self.n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            members = order[begins[b] : begins[b + 1]]
            if len(members) < 2:
                break
            self._displace(b, members, hashes[members], free)
        # A key alone in its bucket takes any empty slot, which the shift names directly.
        alone = np.flatnonzero(sizes == 1)
        empty = np.flatnonzero(free)
        self.shift[alone] = -1 - empty[: len(alone)]
        self.key_at[empty[: len(alone)]] = order[begins[alone]]

    def _displace(self, b: int, members: np.ndarray, hashes: np.ndarray, free: np.ndarray) -> None:
        tried, width = 0, 64
        while True:
            shifts = np.arange(tried, tried + width)
            slots = self._slots(hashes[None, :], shifts[:, None])
            good = free[slots].all(1)
            if good.any():
                for i in np.flatnonzero(good):
                    if len(set(slots[i].tolist())) == len(members):
                        self.shift[b] = shifts[i]
                        self.key_at[slots[i]] = members
                        free[slots[i]] = False
                        return
            tried, width = tried + width, min(4 * width, 1 << 16)

    def _slots(self, hashes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        return (mix(hashes + (shifts.astype(np.uint64) + np.uint64(1)) * _STEP) % np.uint64(self.n)).astype(np.int64)

    def candidates(self, items: list[bytes]) -> list[int]:
        """For each item the only key that it can be equal to."""
        if not items:
            return []
        hashes = hash_items(items)
        shift = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(shift < 0, -1 - shift, self._slots(hashes, np.maximum(shift, 0)))
        return self.key_at[slots].tolist()


def read_ranks(ranks: bytes) -> dict[bytes, int]:
    """A vocabulary given as lines of base64 bytes and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}


@lru_cache(maxsize=2)
def token_bytes(ranks: bytes) -> list[bytes]:
    """The bytes of every id; ids that the vocabulary leaves out have none."""
    table = read_ranks(ranks)
    tokens = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        tokens[rank] = token
    return tokens


class Encoder:
    """Encoder of one vocabulary."""

    def __init__(self, ranks: bytes, pattern: str):
        table = read_ranks(ranks)
        self.tokens = token_bytes(ranks)
        keys = list(table)
        self.ids = [table[k] for k in keys]
        self.whole = PerfectHash(keys)
        self.bytes = [table[bytes([i])] for i in range(256)]
        # For each left part, the rank that it forms with a right part.
        self.pairs: list[dict[int, int]] = [{} for _ in self.tokens]
        for token, rank in table.items():
            for cut in range(1, len(token)):
                left, right = table.get(token[:cut]), table.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left][right] = rank
        self.split = regex.compile(pattern).findall
        self.memory: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary as a whole."""
        ids = [self.bytes[b] for b in piece]
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # A heap entry holds the rank and, in its low bits, the place of the left part.
        low = 12 if n <= 4096 else 40
        mask = (1 << low) - 1
        heap = []
        for i in range(n - 1):
            rank = pairs[ids[i]].get(ids[i + 1])
            if rank is not None:
                heap.append(rank << low | i)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i = entry & mask
            j = after[i]
            # An entry is out of date if its left part is gone or the pair is another by now.
            if j >= n or ids[i] < 0:
                continue
            merged = entry >> low
            if pairs[ids[i]].get(ids[j]) != merged:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = pairs[merged].get(ids[k])
                if rank is not None:
                    heappush(heap, rank << low | i)
            h = before[i]
            if h >= 0:
                rank = pairs[ids[h]].get(merged)
                if rank is not None:
                    heappush(heap, rank << low | h)
        return [x for x in ids if x >= 0]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces = [self.split(t) for t in texts]
        if len(self.memory) > MEMORY:
            self.memory.clear()
        new = list(set().union(*pieces).difference(self.memory))
        raw = [p.encode("utf-8", "replace") for p in new]
        for piece, data, key in zip(new, raw, self.whole.candidates(raw)):
            rank = self.ids[key]
            ids = [rank] if self.tokens[rank] == data else self.merge(data)
            self.memory[piece] = array("i", ids).tobytes()
        known = self.memory.__getitem__
        return [np.frombuffer(b"".join(map(known, p)), np.int32) for p in pieces]


@lru_cache(maxsize=2)
def encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def _vocabulary(df: DataFrame, ranks_path: str):
    """The rank file as a broadcast; its size is that of the vocabulary, whatever the data."""
    with open(ranks_path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every whole text.

    A null or empty text has no ids. Rows are independent: repeated rows give repeated results,
    an empty table gives none, and columns other than ``doc_id, text`` are dropped.
    """
    ranks = _vocabulary(docs, ranks_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks.value, pattern)
        for batch in slices(batches):
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for part in chunks(texts):
                ids = pa.array(coder.encode(texts[part]), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], ids], names=["doc_id", "ids"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``, to ``doc_id, ids``; null ids give no bytes."""
    ranks = _vocabulary(encoded, ranks_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = token_bytes(ranks.value).__getitem__
        for batch in slices(batches):
            lists = batch.column(1)
            pieces = list(map(known, lists.flatten().to_numpy().tolist()))
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy()).tolist()
            decoded = [b"".join(pieces[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
            columns = [batch.column(0), lists, pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, decoded binary")
