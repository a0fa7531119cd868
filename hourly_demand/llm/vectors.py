"""Vectors in Spark columns and Arrow tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with a key and a vector without null, NaN or infinite components; columns id, v and dim."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    good = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    return good.select(F.col(key).cast("bigint").alias("id"), x.alias("v"), F.size(vector).alias("dim"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if rows.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows, np.float64).ravel()))


def blocks(count: int, size: int) -> int:
    return max(1, -(-count // size))


def block(of: int, salt: int = 0) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(of)).cast("int")
