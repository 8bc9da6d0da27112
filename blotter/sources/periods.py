"""Period files as one logical table.

Incident data arrives as several period files with one schema. They are
combined by column name; ``union_periods`` also removes rows that appear in
more than one file (or twice in one), which is a whole-row ``distinct``.

``distinct_by_fingerprint`` gives the same rows with far less shuffling where
few rows are duplicates.

Scale notes: the whole-row ``distinct`` is one hash shuffle on all columns with
a map-side partial aggregate, so a row repeated a billion times collapses in
the map tasks before it is shuffled (no hot partition). Column pruning cannot
pass a whole-row distinct; use ``key_columns`` only where rows with one key are
known to be identical, since keyed dedupe changes results otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import DEFAULT_MAX_BROADCAST_BYTES, measured
from .csv import normalize_columns


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """n-way ``UNION ALL`` by column name (a fold over the list)."""
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    frames = [normalize_columns(f) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_by_fingerprint(df: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """The distinct rows of ``df``, exactly; only rows that may have a duplicate are shuffled whole.

    1. Each row's 64-bit fingerprint is counted; nothing else is shuffled, and
       a fingerprint that very many rows share is combined in each map task.
    2. Fingerprints seen twice or more are written and their size is measured.
    3. In a second scan all other rows pass as they are. Rows with such a
       fingerprint meet by it and are compared in all columns, so rows that
       only share a fingerprint all stay.

    The fingerprints seen twice are broadcast within the measured bound. Beyond
    it duplicates are so many that a whole-row distinct costs less, and is
    done. ``df`` must give the same rows when read again, as files do.
    """
    own = "__fingerprint"
    marked = df.withColumn(own, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    twice = marked.groupBy(own).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).select(own)
    repeated, size = measured(twice)
    if size > max_broadcast_bytes:
        return df.distinct()
    side = F.broadcast(repeated)
    alone = marked.join(side, own, "left_anti").drop(own)
    # The fingerprint is part of the group: equal rows have equal ones.
    compared = marked.join(side, own, "left_semi").distinct().drop(own)
    return alone.unionByName(compared)


def union_periods(frames: Sequence[DataFrame], key_columns: Sequence[str] | None = None, by_fingerprint: bool = False) -> DataFrame:
    """Union period tables by name and drop duplicate rows.

    ``key_columns=None`` (default) is the exact whole-row distinct;
    ``by_fingerprint`` does the same by ``distinct_by_fingerprint``, which runs a
    job to find the duplicates while the DataFrame is built.
    """
    combined = union_all(frames)
    if by_fingerprint and not key_columns:
        return distinct_by_fingerprint(combined)
    if key_columns:
        return combined.dropDuplicates(list(key_columns))
    return combined.distinct()


def tag_and_union(frames: Sequence[tuple[str, DataFrame]], tag_column: str = "period") -> DataFrame:
    """``UNION ALL`` of labelled inputs, each row carrying its label as a literal column."""
    return union_all([df.withColumn(tag_column, F.lit(label)) for label, df in frames])
