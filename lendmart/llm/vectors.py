"""Vectors of whole numbers: from columns of arrays to matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str | Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    v = F.col(vector) if isinstance(vector, str) else vector
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.coalesce(F.exists(v, odd), F.lit(True))


def whole(vector: str | Column, factor: int, shift: int = 0) -> Column:
    """``floor(factor * x) + shift`` of every component as a long; null for a vector that is not usable."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return F.when(usable(v), F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("long") + shift))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, fill: int = 0) -> np.ndarray:
    """The rows of a list column of longs; shorter vectors have ``fill`` at their end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.full((len(lengths), width), fill, np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out
