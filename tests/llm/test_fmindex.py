"""The FM-index against plain string search, and its parts against sorted lists."""

import re

import numpy as np
import pytest

from aerocast.llm.fmindex import Bits, Index, Wavelet, find_leaks, index_documents, index_shard, search_index, sort_suffixes, _ARRAYS
from tests.llm.awkward import BASE, LONG, TEXTS, documents, empty_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {b: b + 32 for b in range(65, 91)}
ITEMS = [
    (1, BASE.upper() + "!"),
    (2, "Start alpha beta"),
    (3, "one"),
    (4, None),
    (5, "... --- !!!"),
    (6, " ".join(LONG.split()[500:540])),
    (7, "words that never occur in any of these documents at all my dear"),
    (8, "nbsp"),
    (9, "la la la la la la la la la la la"),
    (None, "café École"),
    (3, "three FOUR"),
    (10, ""),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def slow_leaks(rows, items, window=10):
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        joined = {n: {} for n in range(1, window + 1)}
        for n, places in joined.items():
            for i in range(len(w) - n + 1):
                places.setdefault(tuple(w[i : i + n]), []).append(i)
        for item, t in items:
            v = words(t)
            n = min(window, len(v))
            for i in range(len(v) - n + 1 if v else 0):
                for at in joined[n].get(tuple(v[i : i + n]), []):
                    hit.update(range(at, at + n))
                    found.add(item)
        out.append((doc_id, len(w), sorted(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def as_rows(found):
    return sorted(
        ((r.doc_id, r.n_words, [i for s, e in r.spans for i in range(s, e)], sorted(r["items"])) for r in found.collect()), key=repr
    )


@pytest.mark.parametrize("block_bytes", [1 << 25, 100])
def test_same_words_and_items_as_plain_search(spark, block_bytes):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "ONE"), (5, BASE), (5, "one; two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, spans string")
    found = find_leaks(docs, items, block_bytes=block_bytes)
    assert as_rows(found) == slow_leaks(rows, ITEMS)
    for r in found.collect():
        assert all(s < e for s, e in r.spans) and all(a[1] < b[0] for a, b in zip(r.spans, r.spans[1:]))


def test_extra_columns_and_no_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_leaks(documents(spark), items).count() == documents(spark).count()
    assert find_leaks(empty_documents(spark), items).count() == 0
    assert find_leaks(documents(spark), items.limit(0)).filter("size(spans) > 0").count() == 0


def test_small_shards_give_the_same(spark):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    index = index_documents(docs, shard_words=50)
    assert index.count() > 4 and index_documents(docs).count() == 1
    items = [(None if i is None else str(i), t.encode()) for i, t in ITEMS if t is not None]
    assert as_rows(search_index(index, *map(list, zip(*items)))) == slow_leaks(rows, ITEMS)


def test_suffixes_and_occurrences():
    random = np.random.default_rng(5)
    for letters, lengths in ((2, [40, 0, 3, 40, 1, 200]), (1, [30, 30, 0]), (50, [500]), (3, [0, 0])):
        first = np.concatenate(([0], np.cumsum(lengths)))
        hashes = random.integers(1, letters + 1, first[-1]).astype(np.uint64) * np.uint64(2**60 // 7)
        arrays = index_shard(hashes, first)
        index = Index(len(hashes), {n: arrays[n].astype(k).tobytes() for n, k in _ARRAYS.items()})
        ends = {int(f) + i for i, f in enumerate(first[1:])}
        for n in (1, 2, 4, 10):
            phrases = np.unique([hashes[i : i + n] for i in range(len(hashes) - n + 1)] or np.zeros((0, n), np.uint64), axis=0)
            expected = set()
            for p, phrase in enumerate(phrases):
                for d, (a, b) in enumerate(zip(first, first[1:])):
                    expected |= {(p, d, i) for i in range(a, b - n + 1) if (hashes[i : i + n] == phrase).all()}
            found = [x for part in index.occurrences(phrases.reshape(-1, n), np.full(len(phrases), n)) for x in zip(*map(np.ndarray.tolist, part))]
            assert len(found) == len(set(found)) and set(found) == expected
        text = np.full(len(hashes) + len(lengths), -1)
        number = np.unique(hashes, return_inverse=True)[1] + len(lengths)
        text[sorted(ends)] = np.arange(len(lengths))
        text[text < 0] = number
        order = sort_suffixes(text, len(lengths) + letters)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_ranks():
    random = np.random.default_rng(6)
    symbols = random.integers(0, 13, 1000)
    bits, zeros = Wavelet.pack(symbols, 4)
    each = len(symbols) // 64 + 1
    tree = Wavelet([Bits(bits[i * each : (i + 1) * each]) for i in range(4)], zeros)
    asked, places = random.integers(0, 14, 500), random.integers(0, 1001, 500)
    assert tree.rank(asked, places).tolist() == [int((symbols[:p] == s).sum()) for s, p in zip(asked, places)]
    there, before = tree.step(np.arange(1000))
    assert there.tolist() == symbols.tolist() and before.tolist() == [int((symbols[:i] == symbols[i]).sum()) for i in range(1000)]
