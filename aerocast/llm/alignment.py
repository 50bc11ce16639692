"""Alignment of two tokenizers over the same bytes, in Arrow.

Both tokenizers cut the bytes of blank + text. A token is known by the document it lies in and by the
byte where it ends, so the full outer hash join of both on these keys gives every cut of either,
and the tokens that hold the bytes before a cut are the next ones that end there or later. A cut of both
ends a group; the bytes between neighbouring cuts are one link.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.words import chunks, slices
from aerocast.session import materialise

#: Pairs of ids, with their counts, that are sent to the workers at once (17 bytes each).
BLOCK_PAIRS = 4_000_000
#: Distinct pairs that a counting task holds before it passes them on.
HELD_PAIRS = 1_000_000
#: Text bytes of a document in the upper bits of a key.
_PLACE = 40
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies.

    Bytes that print stand for themselves; the others follow in order from code point 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE tokenizer file; strings of special tokens in a text are ordinary text.

    Where ids follow the order of merges, the vocabulary is itself a table of ranks, which
    tiktoken applies several times faster than the library of the file.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        added = {t["content"]: t["id"] for t in content["added_tokens"]}
        vocabulary, alphabet = content["model"]["vocab"], _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if token not in added}
        merges = [m if isinstance(m, str) else "".join(m) for m in content["model"]["merges"]]
        order = [vocabulary[m.replace(" ", "")] for m in merges]
        if order != sorted(order):
            raise ValueError("ids of the vocabulary do not follow the order of merges")
        self.tokens = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        self.fast = tiktoken.Encoding("alignment", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            try:
                out.append(self.fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int32))
            except ValueError:
                # Its splitter gives up on runs of about a million blanks.
                out.append(np.array(self.slow.encode(" " + text, add_special_tokens=False).ids, np.int32))
        return out


class Pieces:
    """A sentencepiece model, which puts the blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def aligner(left: str, right: str, pattern: str) -> "Aligner":
    return Aligner(ByteLevel(left, pattern), Pieces(right))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int32)])))


class Aligner:
    """Two tokenizers, and tables by token id: bytes, byte lengths, decimal ids with each separator."""

    def __init__(self, a, b):
        self.sides = (a, b)
        self.bytes = [pa.array(side.tokens, pa.binary()) for side in self.sides]
        self.lengths = [pc.binary_length(tokens).cast(pa.int64()) for tokens in self.bytes]
        self.width = max(map(len, self.bytes))
        self.written = pa.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(self.width)])

    def tokens(self, texts: list[bytes | None]) -> list[pa.ListArray]:
        """Ids by both; a text whose joined tokens are not its bytes has none."""
        plain = [(t or b"").decode("utf-8", "replace") for t in texts]
        wanted = [b" " + t.encode() for t in plain]
        lists = [side.encode(plain) for side in self.sides]
        good = [bool(t) for t in plain]
        for ids, tokens in zip(lists, self.bytes):
            joined = tokens.take(pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))
            ends = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1)[np.cumsum([0] + [len(x) for x in ids])]
            data = memoryview(joined.buffers()[2] or b"")
            good = [g and bytes(data[s:e]) == w for g, s, e, w in zip(good, ends[:-1].tolist(), ends[1:].tolist(), wanted)]
        none = np.zeros(0, np.int32)
        return [_lists([x if g else none for x, g in zip(ids, good)]) for ids in lists]

    def align(self, texts: list[bytes | None]) -> list[pa.Array]:
        """The columns of ALIGNED after ``doc_id``, one entry per text."""
        lists = self.tokens(texts)
        n = len(texts)
        sides = []
        for ids, lengths, name in zip(lists, self.lengths, "ab"):
            flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
            size = lengths.take(flat)
            ends = pc.cumulative_sum(size)
            # The sum starts again with every document.
            begins = np.asarray(ids.offsets)[:-1]
            before = np.concatenate(([0], ends.to_numpy()))[begins]
            place = pc.subtract(ends, pa.array(before).take(parent))
            at = pc.add(pc.shift_left(parent, pa.scalar(_PLACE, pa.int64())), place)
            number = pa.array(np.arange(len(flat)))
            sides.append(pa.table({"at": at, name: flat, f"{name}_no": number}))
        cuts = sides[0].join(sides[1], "at", join_type="full outer", use_threads=False).sort_by("at").combine_chunks()
        document = pc.shift_right(cuts["at"], pa.scalar(_PLACE, pa.int64()))
        shared = pc.and_(pc.is_valid(cuts["a"]), pc.is_valid(cuts["b"]))
        a, b = (pc.fill_null_backward(cuts[name]).cast(pa.int64()) for name in "ab")
        links = pa.table({"document": document, "pair": pc.bit_wise_or(pc.shift_left(a, pa.scalar(32, pa.int64())), b)})
        pairs = links.group_by(["document", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by("document")
        where = document.to_numpy()
        groups = cuts.select(["a_no", "b_no"]).filter(shared)
        borders = np.searchsorted(pairs["document"].to_numpy(), np.arange(n + 1)).astype(np.int32)
        per_text = [
            lists[0].value_lengths().cast(pa.int64()),
            lists[1].value_lengths().cast(pa.int64()),
            pa.array(np.bincount(where[shared.to_numpy()], minlength=n)),
            pa.array(np.bincount(where, minlength=n)),
            pa.array(self.digests(lists, groups["a_no"].to_numpy(), groups["b_no"].to_numpy())),
            pa.ListArray.from_arrays(pa.array(borders), pairs["pair"].combine_chunks()),
            pa.ListArray.from_arrays(pa.array(borders), pairs["count_all"].combine_chunks().cast(pa.int32())),
        ]
        return per_text

    def written_groups(self, lists: list[pa.ListArray], last_a: np.ndarray, last_b: np.ndarray) -> pa.Array:
        """Decimal ids with the separator after each, groups in order, A before B inside a group."""
        ids = [np.asarray(pc.list_flatten(x)) for x in lists]
        group = [np.searchsorted(last, np.arange(len(x))) for x, last in zip(ids, (last_a, last_b))]
        # Before a token of A lie the tokens of B of earlier groups, before one of B those of A of its own too.
        place_a = np.arange(len(ids[0])) + np.concatenate(([0], last_b + 1))[group[0]]
        place_b = np.arange(len(ids[1])) + (last_a + 1)[group[1]]
        mark_a, mark_b = np.zeros(len(ids[0]), np.int64), np.zeros(len(ids[1]), np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        ends = np.asarray(lists[1].offsets)[1:]
        mark_b[ends[lists[1].value_lengths().to_numpy() > 0] - 1] = 3
        entry = np.zeros(len(ids[0]) + len(ids[1]), np.int64)
        entry[place_a] = mark_a * self.width + ids[0]
        entry[place_b] = mark_b * self.width + ids[1]
        return self.written.take(pa.array(entry))

    def digests(self, lists: list[pa.ListArray], last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
        joined = self.written_groups(lists, last_a, last_b)
        borders = np.asarray(lists[0].offsets) + np.asarray(lists[1].offsets)
        ends = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1)[borders].tolist()
        data = memoryview(joined.buffers()[2] or b"")
        return [hashlib.sha256(data[s:e]).hexdigest() if e > s else "" for s, e in zip(ends[:-1], ends[1:])]


def align_documents(docs: DataFrame, left: str, right: str, pattern: str) -> DataFrame:
    """ALIGNED for every row of ``doc_id, text``: counts, digest of the groups, distinct id pairs and how often each.

    ``left`` is a byte-level tokenizer file with its split ``pattern``, ``right`` a sentencepiece model;
    both are installed with the workers. A pair is ``id of left << 32 | id of right``. Texts that are null, empty
    or not given back byte by byte have no tokens. Rows are independent, so repeated rows give
    repeated results and an empty table none; other columns are dropped. Long texts are taken whole, one at a time.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(left, right, pattern)
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(texts):
                columns = [batch.column(0)[part.start : part.stop], *both.align(texts[part])]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(work, ALIGNED)


def count_pairs(aligned: DataFrame) -> DataFrame:
    """``pair, n``: in how many rows of ``aligned`` the pair is linked; tasks pass on partial counts."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            pairs = pc.list_flatten(batch.column(0))
            held.append(merged([pa.table({"pair": pairs, "n": pa.array(np.ones(len(pairs), np.int64))})]))
            if sum(map(len, held)) > 2 * HELD_PAIRS:
                held = [merged(held)]
                if len(held[0]) > HELD_PAIRS:
                    yield from held.pop().to_batches()
        if held:
            yield from merged(held).to_batches()

    return aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _scored(aligned: DataFrame, table: pa.Table) -> DataFrame:
    """``aligned`` with the links of the given pairs added to its sums."""
    table = table.sort_by("pair").combine_chunks()
    known = aligned.sparkSession.sparkContext.broadcast([table[c].to_numpy() for c in ("pair", "n", "best")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times")
            wanted, often = pc.list_flatten(lists).to_numpy(), pc.list_flatten(times).to_numpy().astype(np.int64)
            owner = pc.list_parent_indices(lists).to_numpy()
            at = np.minimum(np.searchsorted(pair, wanted), max(len(pair) - 1, 0))
            hit = np.flatnonzero(pair[at] == wanted) if len(pair) else np.zeros(0, np.int64)
            at, often, owner = at[hit], often[hit], owner[hit]
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], owner, often * best[at])
            np.add.at(sums[1], owner, often * n[at])
            for name, more in zip(("n_best", "count_sum"), sums):
                i = batch.schema.get_field_index(name)
                batch = batch.set_column(i, name, pc.add(batch.column(name), pa.array(more)))
            yield batch

    return aligned.mapInArrow(work, aligned.schema)


def align_corpus(docs: DataFrame, left: str, right: str, pattern: str, block: int = BLOCK_PAIRS) -> DataFrame:
    """One row per document: its tokens by both, groups, links, and how usual its links are in the corpus.

    ``n_best`` counts the links whose pair has the highest count of its left id, ties included, and
    ``count_sum`` adds the counts of all links; rows that repeat a document count as documents. Texts are
    tokenised once; the stored pairs are then looked up in blocks of left ids that hold about ``block``
    pairs, one pass each, so what a worker holds does not grow with the corpus.
    """
    spark = docs.sparkSession
    aligned = materialise(align_documents(docs, left, right, pattern), "aligned")
    counts = materialise(count_pairs(aligned), "pair-counts").withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    table = counts.join(most, "a").select("a", "pair", "n", (F.col("n") == F.col("most")).alias("best"))
    blocks = max(1, -(-counts.count() // block))
    zero = F.lit(0).cast("long")
    out = aligned.withColumns({"n_best": zero, "count_sum": zero})
    for i in range(blocks):
        chosen = table.filter(F.pmod(F.xxhash64("a"), F.lit(blocks)) == i).select("pair", "n", "best")
        out = _scored(out, chosen.toArrow())
        if i + 1 < blocks:
            out = materialise(out, "scored")
    return out.drop("pairs", "times")
