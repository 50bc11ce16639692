"""Near-duplicate vectors by dual traversal of cover trees.

Vectors on the unit sphere are cut by label into blocks; each block gets a cover tree whose levels
halve their radii and whose nodes know the distance to their farthest member. Two trees are
walked together: a pair of nodes is dropped when their centres are farther apart than the
threshold plus both radii, taken whole when even their farthest members must be close enough, and
opened otherwise. The result is exact. Equal vectors are one point with a weight, and a dense
group costs one accepted pair of nodes instead of all pairs of its members.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.components import connected_components
from aerocast.llm.vectors import is_usable, paired_dots, to_matrix
from aerocast.session import materialise

BLOCK = 2048
#: Distances this close to a bound are decided by the cosine itself.
SLACK = 1e-7
#: Ranges with at most this product of sizes are compared member by member.
SMALL = 4096
#: Rows of a block of centre distances.
ROWS = 512


class CoverTree:
    """Points in the order of the tree; a node is a range of them around a centre."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, weights: np.ndarray):
        unit = points / np.linalg.norm(points, axis=1)[:, None]
        near = np.maximum(0, 2 - 2 * (unit @ unit.T))
        order: list[int] = []
        self.begin, self.end, self.centre, self.radius, self.children = [], [], [], [], []
        self._grow(np.arange(len(ids)), 0, 2.0, near, order)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.centre = place[np.array(self.centre, np.int64)]
        self.ids, self.points, self.unit, self.weights = ids[order], points[order], unit[order], weights[order]
        self.begin, self.end, self.radius = np.array(self.begin), np.array(self.end), np.array(self.radius)
        self.children = [np.array(c, np.int64) for c in self.children]

    def _grow(self, members: np.ndarray, centre: int, radius: float, near: np.ndarray, order: list[int]) -> int:
        """Add the node of ``members`` around ``centre``; its points follow those in ``order``."""
        node = len(self.begin)
        reach = float(np.sqrt(near[centre, members].max()))
        self.begin.append(len(order))
        self.end.append(len(order) + len(members))
        self.centre.append(centre)
        self.radius.append(reach)
        self.children.append([])
        if len(members) == 1 or reach <= SLACK:
            order.extend(members.tolist())
            return node
        # Halve the radius until the node splits; its own centre is the first child's centre.
        while radius >= reach:
            radius /= 2
        left, first = members, centre
        while len(left):
            inside = near[first, left] <= radius * radius
            inside |= left == first
            self.children[node].append(self._grow(left[inside], first, radius, near, order))
            left = left[~inside]
            first = int(left[0]) if len(left) else -1
        return node


class Links:
    """Link counts and groups of the points of two trees, filled by a traversal."""

    def __init__(self, left: CoverTree, right: CoverTree | None, cosine: float):
        self.left, self.right, self.cosine = left, right or left, cosine
        self.reach = float(np.sqrt(2 - 2 * cosine))
        self.shift = len(left.ids) if right else 0
        self.parent = list(range(len(left.ids) + (len(right.ids) if right else 0)))
        self.counts = np.zeros(len(self.parent), np.int64)
        self._walk_pair(0, 0) if right else self._walk_self(0)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def _join(self, members) -> None:
        first = self.root(members[0])
        for i in members[1:]:
            other = self.root(i)
            if other != first:
                self.parent[other] = first

    def _walk_self(self, top: int) -> None:
        tree, stack = self.left, [top]
        while stack:
            node = stack.pop()
            a, b = tree.begin[node], tree.end[node]
            if b - a == 1:
                continue
            if 2 * tree.radius[node] <= self.reach - SLACK:
                self.counts[a:b] += tree.weights[a:b].sum() - tree.weights[a:b]
                self._join(range(a, b))
                continue
            kids = tree.children[node]
            if (b - a) ** 2 <= SMALL or not len(kids):
                self._exact(a, b, a, b)
                continue
            stack.extend(kids.tolist())
            self._walk(self._open(kids, kids, above=True))

    def _open(self, xs: np.ndarray, ys: np.ndarray, above: bool = False) -> list[tuple[int, int]]:
        """The pairs of a node of ``xs`` and one of ``ys`` that the bound does not rule out.

        ``above`` asks for pairs of two different entries of one list, each once.
        """
        left, right, kept = self.left, self.right, []
        others, reach = right.unit[right.centre[ys]].T, right.radius[ys] + self.reach + SLACK
        for begin in range(0, len(xs), ROWS):
            part = xs[begin : begin + ROWS]
            squared = 2 - 2 * (left.unit[left.centre[part]] @ others)
            near = squared <= (left.radius[part][:, None] + reach) ** 2
            if above:
                near &= np.arange(len(ys)) > np.arange(begin, begin + len(part))[:, None]
            i, j = np.nonzero(near)
            kept += zip(part[i].tolist(), ys[j].tolist())
        return kept

    def _walk_pair(self, x: int, y: int) -> None:
        self._walk(self._open(np.array([x]), np.array([y])))

    def _walk(self, stack: list[tuple[int, int]]) -> None:
        left, right = self.left, self.right
        while stack:
            x, y = stack.pop()
            a, b, c, d = left.begin[x], left.end[x], right.begin[y], right.end[y]
            gap = np.sqrt(max(0.0, 2 - 2 * float(left.unit[left.centre[x]] @ right.unit[right.centre[y]])))
            if gap + left.radius[x] + right.radius[y] <= self.reach - SLACK:
                self._accept(a, b, c, d)
            elif (b - a) * (d - c) <= SMALL or not (len(left.children[x]) or len(right.children[y])):
                self._exact(a, b, c, d)
            else:
                # Open both nodes; one without children stands for itself.
                xs = left.children[x] if len(left.children[x]) else np.array([x])
                ys = right.children[y] if len(right.children[y]) else np.array([y])
                stack.extend(self._open(xs, ys))

    def _accept(self, a: int, b: int, c: int, d: int) -> None:
        s = self.shift
        self.counts[a:b] += self.right.weights[c:d].sum()
        self.counts[c + s : d + s] += self.left.weights[a:b].sum()
        self._join([*range(a, b), *range(c + s, d + s)])

    def _exact(self, a: int, b: int, c: int, d: int) -> None:
        """Cosines of two ranges; those at the border are taken from the original vectors."""
        left, right, s = self.left, self.right, self.shift
        dots = left.unit[a:b] @ right.unit[c:d].T
        linked = dots >= self.cosine
        i, j = np.nonzero(np.abs(dots - self.cosine) < SLACK)
        if len(i):
            u, v = left.points[a + i], right.points[c + j]
            linked[i, j] = paired_dots(u, v) / np.sqrt(paired_dots(u, u) * paired_dots(v, v)) >= self.cosine
        if s == 0 and a == c:
            linked &= np.triu(np.ones(linked.shape, bool), 1)
        if not linked.any():
            return
        self.counts[a:b] += linked @ right.weights[c:d]
        self.counts[c + s : d + s] += left.weights[a:b] @ linked
        for p, q in zip(*np.nonzero(linked)):
            self._join([a + int(p), c + s + int(q)])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with links, a common member of their group in this pair of blocks, and link counts."""
        ids = self.left.ids if self.shift == 0 else np.concatenate((self.left.ids, self.right.ids))
        used = np.flatnonzero(self.counts)
        roots = np.array([self.root(int(i)) for i in used], np.int64)
        return ids[used], ids[roots], self.counts[used]


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors link when their labels are equal and not null, their widths are equal and their
    cosine is at least ``cosine``. Null, zero and non-finite vectors and rows without a label or
    an id have no links and are their own component. Rows of equal vectors link with each other.
    Rows that repeat an id count as one member of the components. Other columns are dropped.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.when(is_usable("embedding"), F.col("embedding").cast("array<double>")).alias("v"),
    )
    part = F.col("v").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.select(
        "vec_id", "label", "v", F.when(part, F.xxhash64("v")).alias("k1"), F.when(part, F.xxhash64("v", F.lit(1))).alias("k2")
    )
    width = F.size("v").alias("width")
    # Equal vectors of a label are one point; copies meet in the map-side aggregation.
    points = rows.filter(F.col("k1").isNotNull()).groupBy("label", width, "v", "k1", "k2")
    points = materialise(points.agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")), "points")
    sizes = points.groupBy("label", "width").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = points.join(materialise(sizes, "blocks"), ["label", "width"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        matrix = to_matrix(table.column("v"), width)[order]
        tree = CoverTree(ids[order], matrix, table.column("weight").to_numpy()[order])
        names = ["label", "width", "blocks", "block"]
        return pa.table([table.column(n).slice(0, 1) for n in names] + [[pickle.dumps(tree)]], names=[*names, "tree"])

    tree_columns = "label string, width int, blocks int, block int, tree binary"
    trees = materialise(dealt.groupBy("label", "width", "blocks", "block").applyInArrow(build, tree_columns), "trees")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = trees.select("label", "width", "block", "tree", other)
    pairs = pairs.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    def meet(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("block").to_numpy())
        trees = [pickle.loads(table.column("tree")[int(i)].as_py()) for i in order]
        if len(trees) == 1 and table.column("low")[0] != table.column("high")[0]:
            return pa.table([pa.array([], pa.int64())] * 3, names=["id", "root", "links"])  # the other block is empty
        ids, roots, counts = Links(trees[0], trees[1] if len(trees) > 1 else None, cosine).rows()
        return pa.table([pa.array(c, pa.int64()) for c in (ids, roots, counts)], names=["id", "root", "links"])

    met = pairs.groupBy("label", "width", "low", "high").applyInArrow(meet, "id long, root long, links long")
    met = materialise(met, "links")
    groups = connected_components(met, "id", "root")
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    known = points.join(links, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
    known = known.select(
        "label", "k1", "k2", "width", F.coalesce("links", F.lit(0)).alias("_links"), "weight", F.coalesce("component", "id").alias("_component")
    )
    # Stored, so that the rows of one much repeated vector can be split in the join.
    known = materialise(known, "classes")
    keyed = rows.select("vec_id", "label", "k1", "k2", F.size("v").alias("width"))
    joined = keyed.join(known, ["label", "k1", "k2", "width"], "left")
    component = F.coalesce("_component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce(F.col("_links") + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
