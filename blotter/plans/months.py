"""Q1: the k months with the most reported incidents in every year.

One pass: count per (year, month), rank months inside each year, keep k.
The reference's SQL form ran one query per year and unioned them; here both
twins are single-pass. Months are those of the report date; rows without a
report date or without an occurrence date do not count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import not_null
from ..operators.rank import top_k_per_group

REPORTED, OCCURRED = "Date Rptd", "DATE OCC"
REQUIRED = (REPORTED, OCCURRED)


def monthly_counts(incidents: DataFrame, date_col: str = REPORTED, required: Sequence[str] = REQUIRED) -> DataFrame:
    d = F.col(f"`{date_col}`")
    for c in dict.fromkeys([date_col, *required]):
        incidents = not_null(incidents, c)
    return (incidents.groupBy(F.year(d).alias("year"), F.month(d).alias("month"))
            .agg(F.count(F.lit(1)).alias("crime_total")))


def top_months_per_year(incidents: DataFrame, k: int = 3, date_col: str = REPORTED,
                        required: Sequence[str] = REQUIRED) -> DataFrame:
    ranked = top_k_per_group(monthly_counts(incidents, date_col, required), ["year"],
                             [F.desc("crime_total"), F.asc("month")], k)
    return ranked.orderBy("year", "rank")


def top_months_per_year_sql(incidents: DataFrame, k: int = 3, date_col: str = REPORTED,
                            required: Sequence[str] = REQUIRED) -> DataFrame:
    dated = " AND ".join(f"`{c}` IS NOT NULL" for c in dict.fromkeys([date_col, *required]))
    return incidents.sparkSession.sql(f"""
        WITH monthly AS (
            SELECT year(`{date_col}`) AS year, month(`{date_col}`) AS month, COUNT(*) AS crime_total
            FROM {{incidents}}
            WHERE {dated}
            GROUP BY year(`{date_col}`), month(`{date_col}`)
        ), ranked AS (
            SELECT year, month, crime_total,
                   ROW_NUMBER() OVER (PARTITION BY year ORDER BY crime_total DESC, month ASC) AS `rank`
            FROM monthly
        )
        SELECT year, month, crime_total, `rank` FROM ranked WHERE `rank` <= :k ORDER BY year, `rank`
    """, args={"k": k}, incidents=incidents)
