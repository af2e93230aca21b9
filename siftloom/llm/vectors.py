"""Embedding columns as whole numbers, and as matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def usable(column: str) -> Column:
    """The vector is there and all its entries are finite numbers."""
    v = F.col(f"`{column}`")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    return v.isNotNull() & ~bad


def whole(column: str) -> Column:
    """``floor(256 * c)`` of every entry as a long; what lies beyond 64 bits stops at their ends."""
    return F.transform(F.col(f"`{column}`"), lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))


def dimension(rows: DataFrame, column: str) -> int:
    """The most frequent length, the larger of equally frequent ones; 0 without rows."""
    found = rows.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Lists of ``d`` numbers as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)
