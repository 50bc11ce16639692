"""BagMinHash: estimates, groups against brute force, odd input."""

import itertools
from collections import Counter

import numpy as np
import pytest

from aerocast.llm import bagminhash as bm
from aerocast.llm.components import connected_components
from tests.llm.awkward import BASE, LONG, TEXTS, documents, empty_documents


def bag(text):
    words = (text or "").encode().split()
    return Counter([tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words))


def jaccard(a, b):
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 0.0


def groups(texts):
    """Class of each text by comparing all pairs."""
    found, bags = list(range(len(texts))), [bag(t) for t in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        if jaccard(bags[i], bags[j]) >= 0.8:
            old, new = max(found[i], found[j]), min(found[i], found[j])
            found = [new if f == old else f for f in found]
    return found


def test_registers_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 2**63, 400, np.uint64)
    one, two = rng.integers(1, 40, 400), rng.integers(1, 40, 400)
    two[:150] = one[:150]
    m = 4000
    sign = bm.bag_min_hash(np.tile(hashes, 2), np.repeat([0, 1], 400), np.concatenate((one, two)), 2, m)
    true = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert (sign[0] == sign[1]).mean() == pytest.approx(true, abs=4 * np.sqrt(true * (1 - true) / m))
    alone = bm.bag_min_hash(hashes, np.zeros(400, np.int64), one, 1, m)
    assert (alone[0] == sign[0]).all()


def test_exact_similarity():
    texts = [t.encode() if t else t for t in TEXTS]
    common, sizes = bm.overlaps(texts)
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert common[i, j] == sum((bag(TEXTS[i]) & bag(TEXTS[j])).values())
        assert bm.linked(texts, 0.8)[i, j] == (jaccard(bag(TEXTS[i]), bag(TEXTS[j])) >= 0.8)
    assert sizes.tolist() == [sum(bag(t).values()) for t in TEXTS]


@pytest.fixture(scope="module")
def copies():
    """Chains, a large group of near copies, exact copies and strangers."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(12):
        base = rng.choice(words, 120).tolist()
        for step in range(6):
            texts.append(" ".join(base))
            base[int(rng.integers(0, 120))] = f"new{rng.integers(0, 10**9)}"
            if step == 3:
                texts.append(texts[-1])
    base = rng.choice(words, 200).tolist()
    for _ in range(80):
        near = list(base)
        for at in rng.integers(0, 200, 2):
            near[at] = f"own{rng.integers(0, 10**9)}"
        texts.append(" ".join(near))
    texts += [" ".join(rng.choice(words, 60)) for _ in range(40)]
    texts += ["spam line here again " * n for n in (30, 31, 33, 60)]
    order = rng.permutation(len(texts))
    return [texts[i] for i in order]


@pytest.mark.parametrize("block", [256, 10])
def test_groups_match_all_pairs(spark, copies, block):
    df = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string").repartition(6)
    out = bm.near_duplicates(df, block=block).toPandas().sort_values("doc_id")
    want = groups(copies)
    assert out.class_id.tolist() == want
    assert (out.kept == (out.doc_id == out.class_id)).all()
    left = bm.drop_near_duplicates(df).toPandas()
    assert sorted(left.doc_id) == sorted(set(want))


def test_odd_rows(spark):
    docs = documents(spark)
    out = bm.near_duplicates(docs).toPandas()
    assert len(out) == docs.count()
    by_id = out[out.doc_id.notna()].drop_duplicates().set_index("doc_id").class_id
    assert [int(by_id[i]) for i in range(len(TEXTS))] == groups(TEXTS)
    assert out[out.doc_id.isna()].kept.all() and out[out.doc_id.isna()].class_id.isna().all()
    left = bm.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.filter("doc_id IS NULL").count() == 1
    assert bm.near_duplicates(empty_documents(spark)).count() == 0


def test_texts_that_share_an_id(spark):
    """Each text is judged by itself: none that is unlike the others is lost, whatever else has its id."""
    other = "completely different words stand in this second text of the same number"
    rows = [(1, BASE), (2, BASE), (2, other), (2, other), (3, other + " x"), (3, None), (3, ""), (None, BASE), (4, LONG), (4, LONG + " end"), (0, "one two")]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id int, text string, number string").repartition(3)
    left = sorted(((r.doc_id, r.text) for r in bm.drop_near_duplicates(docs).collect()), key=repr)
    texts = [t for i, t in left if i is not None]
    assert texts.count(BASE) == 1 and texts.count(other) + texts.count(other + " x") >= 1 and "one two" in texts
    assert (None, BASE) in left and (3, None) in left and (3, "") in left and len([t for t in texts if t and t.startswith("w0x0")]) == 1
    assert bm.drop_near_duplicates(docs).schema == docs.schema
    out = bm.near_duplicates(docs)
    assert out.count() == len(rows)
    assert sorted(r.kept for r in out.filter("doc_id = 2").collect()) in ([False, True, True], [False, False, False])


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, None)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").toPandas().set_index("node").component
    root = {n: n for e in edges for n in e if n is not None}
    for _ in range(len(root)):
        before = dict(root)
        for a, b in edges:
            if b is not None:
                root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    linked = {n for a, b in edges if b is not None and a != b for n in (a, b)}
    assert got.to_dict() == {n: root[n] for n in linked}
