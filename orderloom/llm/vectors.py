"""Vectors as small integers: rows of array columns to NumPy matrices and back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Vectors that are not null and hold neither nulls nor infinities nor NaN; empty vectors are finite."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def components(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of each component, which stays within -limit and limit."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(float(-limit)), F.least(F.lit(float(limit)), x.cast("double") * scale))).cast("int"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column, all of `width` values, as int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def padded(column: pa.Array) -> np.ndarray:
    """The rows of a list column as int64, zeros behind the shorter ones."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, dtype=np.int64)
    out = np.zeros((len(column), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out
