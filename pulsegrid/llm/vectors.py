"""Embedding rows as integer vectors (each component x becomes floor(256 x)), packed in binary columns.

Rows whose vector is null or holds null or non-finite components take no part. Vectors shorter
than the longest kept one count as ended by zeros. Integer components beyond 2**26 either way stay at that value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
LARGEST = 1 << 26


def complete(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def dimension(rows: DataFrame, vector: str) -> int:
    """Components of the longest vector; 0 for an empty table."""
    return rows.agg(F.max(F.size(vector)).alias("d")).first().d or 0


def quantised(column: pa.Array, dims: int) -> np.ndarray:
    """Complete vectors -> int32 matrix of ``dims`` columns."""
    starts = column.offsets.to_numpy()
    sizes = np.diff(starts)
    values = np.asarray(column.values, np.float64)
    if dims and (sizes == dims).all():
        raw = values[starts[0] : starts[-1]].reshape(-1, dims)
    else:
        raw = np.zeros((len(sizes), dims))
        at = np.repeat(np.arange(len(sizes)), sizes)
        raw[at, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values[starts[0] : starts[-1]]
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * raw), -LARGEST, LARGEST).astype(np.int32)


def blobs(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * rows.shape[1]
    ends = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The inverse of ``blobs``: a matrix of ``width`` columns."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)
