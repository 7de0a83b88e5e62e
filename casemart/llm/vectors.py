"""Reading vector columns: which rows take part, and how they become matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor infinities nor NaNs."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & F.coalesce(~bad, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if len(column) and (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=kind)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(column) else np.zeros(0, np.int64)
    for k, (start, length) in enumerate(zip(starts, lengths)):
        out[k, :length] = values[start:start + length]
    return out
