"""Vectors of floats as rows of small whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

SCALE = 256
MOST = 1 << 28  # of a number's size; their products and sums then stay within 64 bits


def usable(vector: str | Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    infinite = F.lit(float("inf"))

    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == infinite)

    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def integers(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """``(usable, rows)``: which vectors are usable, and ``floor(scale * x)`` of those, a row each.

    Usable vectors of different lengths, or a number of ``MOST`` or more in
    size, are malformed and raise.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(lengths)])
    good = (lengths > 0) & (W.sums((~np.isfinite(values)).astype(np.int64), first) == 0)
    dims = np.unique(lengths[good])
    if len(dims) > 1:
        raise ValueError(f"vectors of different lengths: {dims.tolist()[:5]}")
    width = int(dims[0]) if len(dims) else 0
    numbers = np.floor(values[W.ranges(first[:-1][good], lengths[good])] * scale)
    if len(numbers) and np.abs(numbers).max() >= MOST:
        raise ValueError(f"a component times {scale} is {MOST} or more in size")
    return good, numbers.astype(np.int64).reshape(int(good.sum()), width)


def same_width(df: DataFrame, vector: str) -> int:
    """The length of the usable vectors of ``df``; 0 without any."""
    low, high = df.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low != high:
        raise ValueError(f"vectors of different lengths: {low} to {high}")
    return low or 0
