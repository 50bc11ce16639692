"""The prefix trie against dictionaries of prefixes, over ranges of any size."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aerocast.llm.prefixtrie import common_turns, prefix_trie, rebuilt_sequences
from aerocast.llm.queries import op13_prefix_trie


def slow_trie(rows):
    """Nodes from (conv_id, turn, role, text) rows by the contract of the query."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0), digest, role, text))
    plain = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(plain.get(c - c % 5, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) if children[p] else 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[q] for q in children[p])
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(cs), len(p), up, len(cs), len(children[p]), leaves[p], saved[p], digest))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def query(spark, rows, range_bytes):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, n long")
    known = rebuilt_sequences(table.repartition(4), F.expr("conv_id - conv_id % 5"), F.crc32(F.col("conv_id").cast("string")) % 9, 8)
    return sorted((tuple(r) for r in prefix_trie(known, range_bytes).select(COLUMNS).collect()), key=repr)


def tables():
    dice = random.Random(11)
    words = ["hi", "", "yes", "no, thanks", "é" * 7]

    def talk(n, kinds=3):
        return [(dice.choice(["user", "assistant"]), dice.choice(words[:kinds])) for _ in range(n)]

    few = [(c, t, *x) for c in range(60) for t, x in enumerate(talk(dice.randint(0, 12), 2))]
    common = talk(9)
    hot = [(c, t, *x) for c in range(0, 900, 3) for t, x in enumerate(common)]
    hot += [(c, t, *x) for c in range(1, 900, 3) for t, x in enumerate(common[: c % 10] + talk(3, 5))]
    long = talk(1500)
    chains = [(c, t, *x) for c in (7, 8, 2**40 + 1) for t, x in enumerate(long[: 1500 - c % 7])]
    odd = [(None, 1, "user", "a"), (4, None, None, None), (4, 1, "user", None), (4, 1, "user", None), (4, 0, None, "z"), (4, 0, "b", "z")]
    odd += [(5, 3, "us", "er"), (5, 2, "u", "ser"), (9, 1, "x", "y"), (10, 0, "", ""), (10, 0, "", ""), (3, 2, "a", "b")]
    return {"few": few, "hot": hot, "chains": chains, "odd": odd, "all": few + [(c + 10_000, *r) for c, *r in hot], "none": []}


@pytest.mark.parametrize("name", ["few", "hot", "chains", "odd", "all", "none"])
@pytest.mark.parametrize("range_bytes", [1 << 23, 600])
def test_same_nodes_as_dictionaries(spark, name, range_bytes):
    rows = tables()[name]
    assert query(spark, rows, range_bytes) == slow_trie(rows)


def test_repeated_rows_are_turns(spark, tmp_path):
    rows = tables()["odd"] * 2
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    out = op13_prefix_trie(spark, str(tmp_path))
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=repr) == slow_trie(rows)


def test_common_turns():
    dice = random.Random(2)
    for _ in range(300):
        n, k = dice.randint(0, 40), dice.randint(0, 40)
        a, b = bytes(16 * n), bytes(16 * k)
        at = dice.randint(0, 45)
        b = b[: 16 * at] + b"\1" + b[16 * at + 1 :] if at < k else b
        assert common_turns(a, b) == min(n, k, at)
