"""Harmonic packing of tokenised documents into sequences of one capacity.

A piece of length s belongs to the reciprocal class k = capacity // s, and a bin of that class
always holds k pieces. Documents are cut so that every piece has the largest length of its
class, floor(capacity / k): full bins of a class are then padded by less than k tokens. Since a
class has a fixed count, the place of a piece follows from its rank in the class alone, so
workers fill the bins independently. The pieces of the last, incomplete bin of each class (at
most the sum of k - 1 over the classes, 4,650 for 1,024) are placed first-fit together.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.bpe import encoder
from aerocast.llm.numbering import number_rows
from aerocast.llm.words import chunks, slices
from aerocast.session import materialise

CAPACITY = 1024
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def class_lengths(capacity: int = CAPACITY) -> list[int]:
    """The largest piece length of every reciprocal class, longest first."""
    return sorted({capacity // k for k in range(1, capacity + 1)}, reverse=True)


@lru_cache
def cuts_of_rest(capacity: int = CAPACITY) -> tuple[tuple[int, ...], ...]:
    """For every rest below the capacity, the class lengths it is cut into, longest first."""
    lengths, plans = class_lengths(capacity), [()]
    for rest in range(1, capacity):
        longest = next(s for s in lengths if s <= rest)
        plans.append((longest, *plans[rest - longest]))
    return tuple(plans)


def added_tokens(path: str) -> dict[str, int]:
    """Tokens that a tokenizer file matches in the text itself, before it is split."""
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str, added: tuple[tuple[str, int], ...]):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=dict(added))


def _token_ids(encoding, ranks: bytes, pattern: str, added: tuple[tuple[str, int], ...], text: bytes) -> np.ndarray:
    decoded = text.decode("utf-8", "replace")
    try:
        return encoding.encode_to_numpy(decoded, allowed_special="all")
    except ValueError:
        # The library's splitter gives up on runs of about a million blanks.
        known = dict(added)
        parts = re.split("(" + "|".join(map(re.escape, known)) + ")", decoded) if known else [decoded]
        ids = [np.array([known[p]]) if p in known else encoder(ranks, pattern).encode([p])[0] for p in parts if p]
        return np.concatenate([np.zeros(0, np.int64), *ids])


def cut_documents(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, keep_ids: bool = False, added: dict[str, int] | None = None
) -> DataFrame:
    """Tokenise ``doc_id, text`` and cut every document, with the end id, into class lengths.

    ``ranks_path`` names the vocabulary as ranks; with the ``added`` tokens of the tokenizer file of the
    same vocabulary its ids are that file's. A null text counts as empty and gives one piece with the end id. With
    ``keep_ids`` the token ids of each piece are returned as ``ids``. Other columns are dropped;
    rows that repeat a document are packed like any other rows.
    """
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    # Longer tokens first: of two that match at one place the file's own library takes the longer.
    special = tuple(sorted((added or {}).items(), key=lambda token: -len(token[0])))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, plans = _encoding(ranks.value, pattern, special), cuts_of_rest(capacity)
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                rows, ids_out = [], []
                for doc_id, text in zip(batch.column(0)[part.start : part.stop].to_pylist(), texts[part]):
                    ids = np.append(_token_ids(encoding, ranks.value, pattern, special, text or b""), END_ID).astype("<u4")
                    start, view = 0, memoryview(ids.tobytes())
                    for n in [capacity] * (len(ids) // capacity) + list(plans[len(ids) % capacity]):
                        rows.append((doc_id, start, n, zlib.crc32(view[4 * start : 4 * (start + n)]), len(ids)))
                        if keep_ids:
                            ids_out.append(ids[start : start + n].astype(np.int32))
                        start += n
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns.append(pa.array(ids_out, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(cut, PIECES + (", ids array<int>" if keep_ids else ""))


def place_leftovers(left: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """First-fit of ``left[length]`` pieces: (length, number in its class, bin, offset)."""
    free: list[int] = []
    placed = []
    for length in sorted(left, reverse=True):
        for i in range(left[length]):
            at = next((b for b, room in enumerate(free) if room >= length), len(free))
            if at == len(free):
                free.append(capacity)
            placed.append((length, i, at, capacity - free[at]))
            free[at] -= length
    return placed


def harmonic_pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that are cut to class lengths.

    ``pieces`` must be stored or repeatable, as it is read for the class counts and for the
    placement. Only one count per class reaches the driver.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bases, left, total = [], {}, 0
    for length, n in sorted(counts.items(), reverse=True):
        each = capacity // length
        bases.append((length, each, total, n // each))
        left[length] = n % each
        total += n // each
    classes = spark.createDataFrame(bases, "length long, _each long, _base long, _full long")
    rest = place_leftovers(left, capacity)
    leftovers = spark.createDataFrame(
        [(s, i, total + b, o) for s, i, b, o in rest], "length long, _number long, _rest_bin long, _rest_offset long"
    )
    ranked = number_rows(pieces, ["length"], ["doc_id", "start", "doc_tokens", "ids_crc32"], "_place")
    # Both small sides are bounded by the capacity: one row per class, and the leftovers.
    known = ranked.join(F.broadcast(classes), "length")
    full = F.col("_place") < F.col("_full") * F.col("_each")
    known = known.withColumn("_number", F.col("_place") - F.col("_full") * F.col("_each"))
    known = known.join(F.broadcast(leftovers), ["length", "_number"], "left")
    placed = known.withColumns(
        {
            "sequence_id": F.when(full, F.col("_base") + F.expr("_place div _each")).otherwise(F.col("_rest_bin")),
            "offset": F.when(full, (F.col("_place") % F.col("_each")) * F.col("length")).otherwise(F.col("_rest_offset")),
        }
    )
    return placed.select(*pieces.columns, "sequence_id", "offset")


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = END_ID) -> DataFrame:
    """Token arrays of the sequences, from pieces with ``ids``: padded to the capacity, unless the length is a power of two."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - n))
    return joined.select("sequence_id", F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(padded).alias("ids"))


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    An empty table gives no rows. The pieces are stored once in the session's shared folder, so
    texts are tokenised once and a lost executor does not change the places.
    """
    pieces = materialise(cut_documents(docs, ranks_path, pattern, capacity, added=added), "pieces")
    return harmonic_pack(pieces, capacity)
