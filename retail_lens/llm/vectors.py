"""Vectors as table columns and as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector has a direction: not null, not zero, without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def main_dimension(df: DataFrame, vector: str) -> int:
    """The most frequent number of components, the larger one of a tie; 0 for no rows."""
    n = df.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return n["d"] if n else 0


def matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """Rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dimension)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow for large or small components."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b. A pair's value does not depend on the other pairs."""
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def sampled(df: DataFrame, key: str, vector: str, dimension: int, rows: int) -> np.ndarray:
    """At most ``rows`` vectors, chosen by a hash of the key, on the driver."""
    few = df.orderBy(F.xxhash64(key), key).limit(rows).select(vector).collect()
    return np.array([r[0] for r in few], dtype=np.float64).reshape(-1, dimension)
