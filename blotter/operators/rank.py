"""Ranking, top-k per group, and top/bottom-k.

Every order is made total with tie-break columns so results are deterministic.

Scale notes: ``top_k_per_group`` filters ``row_number() <= k``; Spark plans a
``WindowGroupLimit`` before the shuffle, so each map task forwards at most k
rows per group and a group holding a third of all rows costs no hot task.
``top_and_bottom_k`` uses ordered limits (``TakeOrderedAndProject``): each
partition keeps k rows, then k * partitions rows are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[ColumnOrName], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k inside each group by ``order`` (ties broken by the later keys)."""
    w = Window.partitionBy(*group_cols).orderBy(*[_col(o) for o in order])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k(df: DataFrame, order: Sequence[ColumnOrName], k: int) -> DataFrame:
    """First k rows by ``order``."""
    return df.orderBy(*[_col(o) for o in order]).limit(k)


def top_and_bottom_k(df: DataFrame, value: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The k highest and the k lowest rows by ``value``, as one ``UNION ALL``.

    The highest come first, then the lowest re-sorted descending, as the
    reference lays them out; order is only meaningful if the caller sorts.
    """
    desc = [F.col(value).desc()] + [F.col(t).asc() for t in tie_break]
    asc = [F.col(value).asc()] + [F.col(t).asc() for t in tie_break]
    highest = top_k(df, desc, k)
    lowest = top_k(df, asc, k)
    return highest.unionByName(lowest)
