"""Helpers for columns of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_usable(vector: str) -> Column:
    """True for vectors that are not null, not zero and hold only finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def to_matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of one width as a matrix of doubles."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def paired_dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components wherever a pair is computed."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total
