"""Helpers for columns of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (id long, vector array of double) that take part: id not null, vector not null,
    not zero, all components finite, and as long as most are (ties: the longest)."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(fine & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0].n if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow column of equally long lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of two equally long matrices."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
