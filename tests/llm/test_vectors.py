"""Search and near-duplicate vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocast.llm import blocksearch, covertree
from tests.llm.awkward import vectors

NAN, INF = float("nan"), float("inf")
BAD = [None, [], [0.0] * 8, [NAN] * 8, [INF] + [0.0] * 7, [None] + [1.0] * 7]


@pytest.fixture(scope="module")
def data():
    """Clusters of different width, exact copies, scaled copies and unusable vectors."""
    rng = np.random.default_rng(6)
    rows = []
    for c in range(14):
        centre = rng.normal(size=8)
        for _ in range(25):
            rows.append(centre + rng.normal(size=8) * (0.02 + 0.05 * c))
    rows += [rows[0]] * 60 + [rows[3] * 2.0, rows[3] * 0.5]
    made = [(i, [float(np.float32(x)) for x in v], i % 3 if i % 11 else None) for i, v in enumerate(rows)]
    made += [(1000 + i, v, 1) for i, v in enumerate(BAD)]
    made += [(2000, [1.0, 2.0, 3.0], 1), (2020, [1.0, 2.0, 3.125], 1), (None, [1.0] * 8, 1)]
    return [(*r, "x", "y") for r in made]


def usable(data):
    return [(i, np.array(v, float), g) for i, v, g, *_ in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]


@pytest.mark.parametrize("blocks", [(2048, 8192), (7, 50)])
def test_search(spark, data, blocks):
    df = vectors(spark, data).repartition(5)
    got = blocksearch.search(df, F.col("vec_id") % 20 == 0, 20, *blocks).toPandas()
    rows = usable(data)
    for q, v, _ in rows:
        if q % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w, _ in rows if i != q and len(w) == len(v))[:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, len(scored) + 1))
        assert mine.vec_id.tolist() == [i for _, i in scored]
        assert mine.score.tolist() == [-s for s, _ in scored]
    assert set(got.query_id) == {i for i, v, _ in rows if i % 20 == 0}


def test_error_bounds_hold():
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(50, 64)), rng.normal(size=(60, 64)) * 10
    a, b = blocksearch.Quantised(x), blocksearch.Quantised(y)
    approx = (a.codes @ b.codes.T) * (a.scale[:, None] * b.scale)
    bound = a.size[:, None] * b.error + a.error[:, None] * (b.size + b.error)
    assert (np.abs(x @ y.T - approx) <= bound + 1e-9).all() and np.abs(a.codes).max() <= 127


@pytest.mark.parametrize("block", [2048, 16, 1])
@pytest.mark.parametrize("cosine", [0.93, 0.5])
def test_links_and_components(spark, data, block, cosine):
    if block == 1 and cosine == 0.5:
        pytest.skip("one setting of single-point blocks is enough")
    small = data if block > 1 else data[300:]
    got = covertree.near_duplicates(vectors(spark, small).repartition(5), cosine, block).toPandas()
    assert len(got) == len(small)
    rows = [r for r in usable(small) if r[2] is not None]
    links = {i: set() for i, *_ in small if i is not None}
    for i, v, g in rows:
        for j, w, h in rows:
            if i < j and g == h and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= cosine:
                links[i].add(j)
                links[j].add(i)
    least = {}
    for start in sorted(links):
        stack = [start]
        while stack:
            node = stack.pop()
            if node not in least:
                least[node] = start
                stack += links[node]
    found = got[got.vec_id.notna()].set_index("vec_id")
    assert {i: (len(links[i]), least[i], i == least[i]) for i in links} == {
        int(i): (r.n_links, int(r.component_id), r.kept) for i, r in found.iterrows()
    }
    assert got[got.vec_id.isna()].kept.tolist() == [True]


def test_cover_tree_invariants():
    rng = np.random.default_rng(8)
    points = np.concatenate([rng.normal(size=(60, 8)), np.repeat(rng.normal(size=(1, 8)), 5, 0) + rng.normal(size=(5, 8)) * 1e-3])
    tree = covertree.CoverTree(np.arange(65), points, np.ones(65, np.int64))
    for node, kids in enumerate(tree.children):
        inside = tree.unit[tree.begin[node] : tree.end[node]]
        gaps = np.linalg.norm(inside - tree.unit[tree.centre[node]], axis=1)
        assert gaps.max() <= tree.radius[node] + 1e-6
        if len(kids):
            assert tree.centre[kids[0]] == tree.centre[node]
            assert tree.begin[kids].tolist() == [tree.begin[node], *tree.end[kids[:-1]]] and tree.end[kids[-1]] == tree.end[node]
    assert sorted(tree.ids) == list(range(65))


def test_empty_tables(spark):
    none = vectors(spark, [])
    assert blocksearch.search(none, F.col("vec_id") % 20 == 0).count() == 0
    assert covertree.near_duplicates(none).count() == 0
    bad = vectors(spark, [(i, v, 1, "x", "y") for i, v in enumerate(BAD)])
    assert blocksearch.search(bad, F.lit(True)).count() == 0
    assert covertree.near_duplicates(bad).filter("kept AND n_links = 0").count() == len(BAD)
