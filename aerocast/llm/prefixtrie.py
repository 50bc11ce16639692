"""Prefix trie of conversations from union-find over the common prefixes of sorted neighbours.

Conversations become sequences of turn digests. Distinct sequences are sorted into ranges; inside a
range the lengths of the common prefixes of neighbours are edges, taken deepest first: each merge of two
components makes the branching node of that depth, or meets one that is there already. What a range shares
with the ranges around it are the prefixes of its first and last sequence. Its forest is contracted to
these paths, whose sums over the range are added up across borders, while all other nodes are finished in
the range. Sums that need the members of a whole node, such as saved bytes, are kept in a form that adds up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocast.session import materialise

#: Bytes of one turn's digest.
DIGEST = 16
#: Bytes of digests that a range of sequences holds, about.
RANGE_BYTES = 8 << 20
#: Ids of a conversation block whose texts are joined natively: 2 ** BLOCK_BITS neighbouring ids.
BLOCK_BITS = 12
#: Digested sequences that a task passes on at once.
FLUSH = 10_000
NODES = (
    "part int, open_no int, parent_no int, node binary, parent_node binary, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
)
#: Stands for the number of a node that is not open.
NONE = np.iinfo(np.int32).max
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: an array of (digest, bytes of the text) per conversation.

    Turns follow ``turn``, null first, and among rows of one turn number the digest; null roles and texts
    are empty. Rows without a ``conv_id`` belong to no conversation, repeated rows are repeated turns, other
    columns are dropped. A conversation's digests are held in one row (24 bytes a turn), its texts are not.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps (role, text) apart from other pairs with the same joined bytes.
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).alias("bytes")).alias("t"),
    )
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"))


def splice(turns: DataFrame, base: Column, count: Column, most: int) -> DataFrame:
    """Each conversation with its first ``count`` turns replaced by those of conversation ``base``.

    Fewer are taken if the other has fewer, none if it is absent. ``most`` bounds ``count``, so only so many turns of
    a conversation are sent to others.
    """
    heads = turns.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    joined = turns.withColumns({"_base": base, "_count": count.cast("int")}).join(heads, "_base", "left")
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_count")), F.array().cast(turns.schema["turns"].dataType))
    tail = F.slice("turns", F.col("_count") + 1, F.greatest(F.size("turns") - F.col("_count"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, tail).alias("turns"))


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, key, bytes``: the joined digests of a conversation's turns and the bytes of each text."""
    joined = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return turns.select("conv_id", F.unhex(joined).alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))


def distinct_sequences(known: DataFrame) -> DataFrame:
    """``conv_id, key, bytes, n, ends``: each distinct sequence with its smallest id, members and digest of their ids.

    Ids are joined in blocks of neighbouring ids, so a sequence that very many conversations share is put together by
    many tasks; the joined blocks are then hashed in order as a stream.
    """
    # Ids of a block are distinct and neighbours, so a list holds 2 ** BLOCK_BITS at most.
    ids = F.sort_array(F.collect_list("conv_id"))
    blocks = known.groupBy(F.sha2("key", 256).alias("sequence"), F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.concat_ws(",", ids.cast("array<string>")).alias("ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, str]] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "n", "ends"])

        current, n, least, state = None, 0, 0, hashlib.sha256()
        for batch in batches:
            for sequence, size, first, text in zip(*(c.to_pylist() for c in batch.columns)):
                if sequence == current:
                    state.update(b",")
                else:
                    if current is not None:
                        out.append((least, n, state.hexdigest()))
                    current, n, least, state = sequence, 0, first, hashlib.sha256()
                state.update(text.encode())
                n += size
            if len(out) > FLUSH:
                yield flush()
        if current is not None:
            out.append((least, n, state.hexdigest()))
            yield flush()

    ordered = blocks.repartition("sequence").sortWithinPartitions("sequence", "block")
    members = ordered.select("sequence", "n", "least", "ids").mapInArrow(digest, "conv_id long, n long, ends string")
    return known.join(members, "conv_id")


def common_turns(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two sequences of digests, by halving."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = min((low + high + 1) // 2, 2 * low + 1)
        if a[low * DIGEST : middle * DIGEST] == b[low * DIGEST : middle * DIGEST]:
            low = middle
        elif middle == low + 1:
            return low
        else:
            high = middle - 1
    return low


class Forest:
    """The trie of the sorted, distinct sequences of a range.

    Compressed nodes are the ends of sequences (0..m-1) and the branching nodes that merges make; the
    prefixes between a node and its parent have the same members. ``left`` and ``right`` say how many turns the first
    and last sequence share with the neighbours beyond the range, -1 without a neighbour.
    """

    def __init__(self, keys: list[bytes], sizes: list[list[int]], members: list[int], least: list[int], left: int, right: int):
        m = len(keys)
        self.m, self.left, self.right = m, left, right
        self.depth = [len(k) // DIGEST for k in keys]
        self.parent, self.first, self.last = [-1] * m, list(range(m)), list(range(m))
        self.n, self.least, self.children, self.below = list(members), list(least), [0] * m, [0] * m
        # Bytes of the first 0, 1, 2, ... texts of each sequence, one after the other.
        self.at = np.cumsum([0] + [d + 1 for d in self.depth[:-1]])
        flat = np.concatenate([np.append(0, s) for s in sizes]).astype(np.int64)
        total = np.cumsum(flat)
        self.total = total - np.repeat(total[self.at], np.diff(np.append(self.at, len(flat))))
        shared = [common_turns(a, b) for a, b in zip(keys, keys[1:])]
        self.leaves = [int(d > s) for d, s in zip(self.depth, [*shared, right])]
        self._merge(shared)

    def _merge(self, shared: list[int]) -> None:
        """Union-find over the edges between neighbours, deepest first and from left to right."""
        component, top = list(range(self.m)), list(range(self.m))

        def find(i: int) -> int:
            while component[i] != i:
                component[i] = component[component[i]]
                i = component[i]
            return i

        for edge in sorted(range(len(shared)), key=lambda i: -shared[i]):
            depth, a, b = shared[edge], find(edge), find(edge + 1)
            node = top[a]
            # What lies right of an edge is deeper: sequences are sorted, and its own edges of this depth come later.
            if self.depth[node] != depth:
                node = self._branch(depth, top[a])
            self._attach(top[b], node)
            component[b], top[a] = a, node
        if self.depth[top[0]]:
            self._branch(0, top[0])

    def _branch(self, depth: int, child: int) -> int:
        for column, value in (
            (self.depth, depth), (self.parent, -1), (self.first, self.first[child]), (self.last, self.last[child]),
            (self.n, 0), (self.least, self.least[child]), (self.children, 0), (self.below, 0), (self.leaves, 0),
        ):
            column.append(value)
        self._attach(child, len(self.depth) - 1)
        return len(self.depth) - 1

    def _attach(self, child: int, node: int) -> None:
        """Hang a finished node below ``node`` and add its sums."""
        self.parent[child] = node
        self.last[node] = max(self.last[node], self.last[child])
        self.n[node] += self.n[child]
        self.least[node] = min(self.least[node], self.least[child])
        self.children[node] += 1
        self.leaves[node] += self.leaves[child]
        saved = self._saved(self.first[child], self.n[child], self.depth[child], self.depth[node] + 1)
        self.below[node] += self.below[child] + int(saved)

    def _saved(self, row, n, deep, depth):
        """Bytes saved by the prefixes of ``depth`` to ``deep`` turns that ``n`` members share with a row.

        Each text counts once less than members, unless an earlier range, which has the prefix too, counts it off;
        so sums over ranges add up. Takes numbers or arrays.
        """
        begin = np.maximum(depth - 1, 0)
        counted = np.where(np.equal(row, 0), np.minimum(deep, np.maximum(begin, self.left)), begin)
        at = self.at[row]
        end = self.total[at + deep]
        return n * (end - self.total[at + begin]) - (end - self.total[at + counted])

    def nodes(self, part: int, keys: list[bytes], ends: list[str]) -> pa.Table:
        """NODES of the range, one row for every prefix; those shared with other ranges are open and have a number."""
        depth, parent, first, last, n, least, children, below, leaves = (
            np.array(x, np.int64)
            for x in (self.depth, self.parent, self.first, self.last, self.n, self.least, self.children, self.below, self.leaves)
        )
        above = np.where(parent < 0, -1, depth[parent])
        counts = depth - above
        node = np.repeat(np.arange(len(depth)), counts)
        d = np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts) + above[node] + 1
        topmost, deepest = d == above[node] + 1, d == depth[node]

        def number(holder: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Of an open prefix, its depth on the first path, or else minus its depth on the last; none otherwise."""
            on_first = (first[holder] == 0) & (at <= self.left)
            on_last = (last[holder] == self.m - 1) & (at <= self.right)
            return np.where(on_first, at, np.where(on_last, -1 - at, NONE))

        upper = np.where(topmost, parent[node], node)
        own, higher = number(node, d), np.where(d > 0, number(upper, d - 1), NONE)
        child_before = (first[node] == 0) & (d + 1 <= self.left)
        end_here = deepest & (node < self.m)
        texts = pa.array(ends, pa.string()).take(pa.array(node[end_here]))
        spread = np.where(end_here, np.cumsum(end_here) - 1, 0)
        opened = np.flatnonzero(own != NONE)
        digests = {}
        for row in {0, self.m - 1}:
            state = hashlib.md5()
            digests[row, 0] = state.digest()
            for k in range(1, max(self.left if row == 0 else 0, self.right if row == self.m - 1 else 0) + 1):
                state.update(keys[row][(k - 1) * DIGEST : k * DIGEST])
                digests[row, k] = state.digest()
        ids, parents = [None] * len(node), [None] * len(node)
        for i in opened.tolist():
            row = 0 if own[i] >= 0 else self.m - 1
            ids[i] = digests[row, int(d[i])]
            parents[i] = digests[row, int(d[i]) - 1] if d[i] else None
        columns = {
            "part": pa.array(np.full(len(node), part, np.int32)),
            "open_no": pa.array(own.astype(np.int32), mask=own == NONE),
            "parent_no": pa.array(higher.astype(np.int32), mask=higher == NONE),
            "node": pa.array(ids, pa.binary()),
            "parent_node": pa.array(parents, pa.binary()),
            "conv_id": pa.array(least[node]),
            "depth": pa.array(d),
            "parent_conv_id": pa.array(least[upper], mask=d == 0),
            "n_convs": pa.array(n[node]),
            "n_children": pa.array(np.where(deepest, children[node], 1) - child_before),
            "n_leaves": pa.array(leaves[node]),
            "saved_tokens": pa.array(below[node] + self._saved(first[node], n[node], depth[node], d)),
            "ends": texts.take(pa.array(spread, mask=~end_here)),
        }
        return pa.table(columns)


def _ranges(distinct: DataFrame, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``distinct`` with ``part``, ranges of keys; and ``of, before, after``, the keys next to each range."""
    size = distinct.agg(F.sum(F.octet_length("key"))).first()[0] or 0
    parts = int(size // range_bytes) + 1
    dealt = materialise(distinct.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "trie-ranges")
    borders = dealt.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # One number per range of several MB is ordered here, no keys.
    along = Window.orderBy("part")
    order = borders.select("part", F.lag("part").over(along).alias("previous"), F.lead("part").over(along).alias("next"))
    before = borders.select(F.col("part").alias("previous"), F.col("high").alias("before"))
    after = borders.select(F.col("part").alias("next"), F.col("low").alias("after"))
    return dealt, order.join(before, "previous", "left").join(after, "next", "left").select(F.col("part").alias("of"), "before", "after")


def _forest_nodes(rows: pa.Table, border: pa.Table) -> pa.Table:
    rows = rows.combine_chunks()
    keys = rows["key"].to_pylist()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    keys = [keys[i] for i in order]
    columns = {c: rows[c].take(pa.array(order)).to_pylist() for c in ("bytes", "n", "conv_id", "ends")}
    before, after = border["before"][0].as_py(), border["after"][0].as_py()
    left = -1 if before is None else common_turns(before, keys[0])
    right = -1 if after is None else common_turns(keys[-1], after)
    forest = Forest(keys, columns["bytes"], columns["n"], columns["conv_id"], left, right)
    return forest.nodes(rows["part"][0].as_py(), keys, columns["ends"])


def prefix_trie(known: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per node of the trie of ``conv_id, key, bytes`` (see ``sequences``), which must be stored or repeatable.

    ``conv_id`` is the smallest member, ``depth`` the turns of the prefix, ``n_convs`` its members, ``n_leaves`` and
    ``saved_tokens`` sum over its subtree, ``ends_sha256`` digests the members that end here. Ids are distinct;
    sequences without turns are members of the root alone, and no sequences give no nodes.
    """
    distinct = materialise(distinct_sequences(known), "trie-sequences")
    dealt, borders = _ranges(distinct, range_bytes)
    nodes = dealt.groupBy("part").cogroup(borders.groupBy("of")).applyInArrow(_forest_nodes, NODES)
    nodes = materialise(nodes, "trie-nodes")
    opened = nodes.filter("node IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    # A range has two paths, so a node that very many conversations share has few rows, already summed.
    merged = opened.groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends"), F.min("parent_node").alias("parent_node")
    )
    merged = materialise(merged, "trie-open")
    parents = merged.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    shown = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    ]
    # Open nodes learn their parent by its prefix, finished ones by its number in their range, which is no hot key.
    upper = merged.join(parents, "parent_node", "left").select(*shown)
    numbered = opened.select("part", F.col("open_no").alias("parent_no"), "node")
    numbered = numbered.join(merged.select("node", F.col("conv_id").alias("_open")), "node").drop("node")
    lower = nodes.filter("node IS NULL").join(numbered, ["part", "parent_no"], "left")
    lower = lower.withColumn("parent_conv_id", F.coalesce("_open", "parent_conv_id")).select(*shown)
    return upper.unionByName(lower)


def rebuilt_sequences(conversations: DataFrame, base: Column, count: Column, most: int) -> DataFrame:
    """``sequences`` of all conversations, each with its first turns taken from another (see ``splice``)."""
    turns = materialise(conversation_turns(conversations), "turns")
    return materialise(sequences(splice(turns, base, count, most)), "sequences")
