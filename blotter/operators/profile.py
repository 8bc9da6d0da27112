"""Row counts and a schema report, returned as DataFrames (not printed).

``schema_report`` computes every column's non-NULL count in one aggregate pass
(partial aggregation per task, one row out), then turns the single row into
one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """One row: ``count(*)``."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def row_counts(named: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One row per input: (table, row_count)."""
    parts = [row_count(df).select(F.lit(name).alias("table"), "row_count") for name, df in named]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: (position, column_name, data_type, nullable, non_null_count)."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.lit(f.nullable).alias("nullable"), F.col(f"c{i}").alias("non_null_count"))
        for i, f in enumerate(fields)
    ])
    return counts.select(F.inline(rows))
