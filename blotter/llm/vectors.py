"""Vectors as whole numbers: the rows that operators 12 and 13 work on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256
#: Components must stay below this after scaling, so that squares and products of the numbers are exact in 64 bits.
LARGEST = 1 << 24


def whole(vector: Column) -> Column:
    """True for vectors that are not null and not empty and whose components are all finite numbers."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def scaled(vector: Column) -> Column:
    """floor(256 * x) of each component, x as double; an error beyond ``LARGEST``, since sums would not be exact."""
    number = lambda v: F.floor(v.cast("double") * SCALE)
    fits = F.forall(vector, lambda v: F.abs(v.cast("double")) * SCALE < LARGEST)
    message = F.lit(f"a component times {SCALE} is not below {LARGEST}; scale the vectors")
    return F.when(fits, F.transform(vector, lambda v: number(v).cast("int"))).otherwise(F.raise_error(message).cast("array<int>"))


def stacked(column, size: int) -> np.ndarray:
    """The arrays of a pandas or Arrow column as rows of 64-bit integers."""
    rows = [np.asarray(x, dtype=np.int64) for x in column]
    return np.stack(rows) if rows else np.empty((0, size), np.int64)
