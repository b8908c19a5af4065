"""Vectors as Arrow columns: which rows take part, and rows of a list column as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither null, NaN nor infinity; never null."""
    v = vector.cast("array<double>")
    sound = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(v.isNotNull() & sound, F.lit(False))


def as_floats(vector: Column, kind: T.DataType) -> Column:
    """Single precision stays as it is, every other element type becomes double."""
    return vector if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else vector.cast("array<double>")


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column in double precision, continued by zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.astype(np.float64).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
