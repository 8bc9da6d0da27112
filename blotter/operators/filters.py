"""Row filters with explicit NULL / NaN behaviour.

All are plain predicates, so Catalyst pushes them through unions, distinct
and joins down to the scan (``PushedFilters`` on Parquet).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every column in ``cols`` is non-NULL (NaN is kept)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"`{c}`").isNotNull()
    return df.filter(cond)


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with no NULL in ``cols``, and no NaN in floating columns among them.

    Same rows as ``df.na.drop(subset=cols)``; written as one predicate.
    """
    types = dict((f.name, f.dataType) for f in df.schema)
    cond = F.lit(True)
    for c in cols:
        col = F.col(f"`{c}`")
        cond = cond & col.isNotNull()
        if isinstance(types[c], (T.FloatType, T.DoubleType)):
            cond = cond & ~F.isnan(col)
    return df.filter(cond)


def in_range(col: str | Column, lo, hi) -> Column:
    """Closed range ``lo <= col <= hi``; NULL is outside."""
    c = F.col(f"`{col}`") if isinstance(col, str) else col
    return c.between(lo, hi)


def exclude_keys(df: DataFrame, col: str, keys: Iterable) -> DataFrame:
    """Rows whose ``col`` is none of ``keys``.

    Written as ``NOT (c = k1 OR c = k2 ..)``: under three-valued logic a NULL
    key is dropped too, as the reference's filter does.
    """
    c = F.col(f"`{col}`")
    hit = F.lit(False)
    for k in keys:
        hit = hit | (c == F.lit(k))
    return df.filter(~hit)


def drop_null_island(df: DataFrame, lat: str = "LAT", lon: str = "LON") -> DataFrame:
    """Rows whose coordinates are not the (0, 0) placeholder (NULL coordinates are kept).

    Opt-in: the reference keeps such rows, which inflates distance means.
    """
    la, lo = F.col(f"`{lat}`"), F.col(f"`{lon}`")
    return df.filter(~((la == 0.0) & (lo == 0.0)) | la.isNull() | lo.isNull())
