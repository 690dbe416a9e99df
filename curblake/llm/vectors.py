"""Arrow columns of vectors as matrices, and which vectors take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Not null, and no component null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """A list column as rows of a matrix; shorter lists are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width, flat = int(lengths.max(initial=0)), column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width).astype(dtype)
    out = np.zeros((len(lengths), width), dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out
