"""Exact nearest neighbours by a block matrix join over int8 tiles.

Queries and candidates are dealt into blocks; each pair of blocks is one task. There, vectors are
rounded to int8 with one scale each, and products of tiles give every inner product with a bound
on its error: for x = s q + e, |xy - approx| <= |s q||e'| + |e|(|s' q'| + |e'|). Pairs whose upper
bound reaches the k-th best lower bound are computed again in doubles, so nothing is lost.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocast.llm.vectors import is_usable, paired_dots, to_matrix

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
TILE = 256
#: Sums of int8 products are exact in float32 up to this width.
EXACT_WIDTH = (1 << 24) // (127 * 127)


class Quantised:
    """Vectors as int8 with a scale, and the norms that bound the rounding error."""

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(1) / 127
        codes = np.rint(x / self.scale[:, None]).astype(np.int8)
        rounded = codes * self.scale[:, None]
        self.codes = codes.astype(np.float32 if x.shape[1] <= EXACT_WIDTH else np.float64)
        self.size = np.linalg.norm(rounded, axis=1)
        self.error = np.linalg.norm(x - rounded, axis=1)


def nearest_in_block(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, r_ids: np.ndarray, k: int):
    """(query id, row id, inner product) of the k nearest rows of each query; equal ids are no pair."""
    found = []
    all_q, all_r = Quantised(queries), Quantised(rows)
    for begin in range(0, len(queries), TILE):
        q = slice(begin, begin + TILE)
        approx = (all_q.codes[q] @ all_r.codes.T) * (all_q.scale[q][:, None] * all_r.scale)
        bound = all_q.size[q][:, None] * all_r.error + all_q.error[q][:, None] * (all_r.size + all_r.error)
        bound = bound * (1 + 1e-9) + 1e-12 * all_q.size[q][:, None] * all_r.size
        own = q_ids[q][:, None] == r_ids
        low = np.where(own, -np.inf, approx - bound)
        least = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(low), -np.inf)
        at_q, at_r = np.nonzero((approx + bound >= least[:, None]) & ~own)
        scores = paired_dots(queries[q][at_q], rows[at_r])
        borders = np.searchsorted(at_q, np.arange(len(low) + 1))
        for i, (a, b) in enumerate(zip(borders[:-1], borders[1:])):
            best = heapq.nsmallest(k, zip((-scores[a:b]).tolist(), r_ids[at_r[a:b]].tolist()))
            found += [(int(q_ids[begin + i]), row, -score) for score, row in best]
    return found


def search(vectors: DataFrame, is_query: Column, k: int = 20, query_block: int = QUERY_BLOCK, row_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the largest inner product of each query.

    ``vectors`` has ``vec_id, embedding``; other columns are dropped. Unusable vectors (null, zero,
    with null or non-finite components) and rows without an id take no part, and only vectors of
    equal width are compared. Ties go to the smaller id. A query gets fewer rows if there are
    fewer candidates; rows of its own id are none. An empty table gives no rows.
    """
    usable = vectors.filter(is_usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").cast("array<double>").alias("v"),
        F.size("embedding").alias("width"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    sizes = usable.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    q_blocks, r_blocks = max(1, math.ceil(sizes["q"] / query_block)), max(1, math.ceil(sizes["n"] / row_block))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # Rows meet every block of queries and queries every block of rows, in tiles of bounded size.
    asked = usable.filter("asks").select("width", block(q_blocks).alias("qb"), every(r_blocks).alias("rb"), F.lit(True).alias("asks"), "id", "v")
    rows = usable.select("width", every(q_blocks).alias("qb"), block(r_blocks).alias("rb"), F.lit(False).alias("asks"), "id", "v")

    def tile(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        asks = table.column("asks").to_numpy()
        ids, matrix = table.column("id").to_numpy(), to_matrix(table.column("v"), width)
        found = []
        if asks.any():
            order = np.argsort(ids[asks], kind="stable")
            found = nearest_in_block(matrix[asks][order], ids[asks][order], matrix[~asks], ids[~asks], k)
        columns = list(zip(*found)) or [[], [], []]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    near = asked.unionByName(rows).groupBy("width", "qb", "rb").applyInArrow(tile, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
