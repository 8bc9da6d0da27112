"""Q3: victims by descent in the k richest and k poorest ZIP codes of a year.

Steps (each a Spark operator, nothing on the driver):
income -> drop NULL incomes and excluded ZIPs -> top-k and bottom-k ZIPs
(ordered limits) -> reverse-geocode rows of those ZIPs -> distinct
coordinate pairs -> facts of the year restricted to those pairs (semi join)
-> count per descent label.

The year filter is a range on the raw timestamp so Parquet row groups are
skipped; the income dimension is 2k rows after top/bottom-k, and the
restricted pair set is checkpointed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import DESCENT_LABELS, code_label
from ..operators.filters import exclude_keys
from ..operators.joins import restrict_by_dimension
from ..operators.rank import top_and_bottom_k

INCOME, ZIP = "Estimated Median Income", "Zip Code"


def year_equals(c: Column, year: int, data_type: str = "timestamp_ntz") -> Column:
    """``year(c) = year`` written as a half-open range the scan can use."""
    lo = F.lit(f"{year}-01-01 00:00:00").cast(data_type)
    hi = F.lit(f"{year + 1}-01-01 00:00:00").cast(data_type)
    return (c >= lo) & (c < hi)


def income_extremes(income: DataFrame, k: int = 3, exclude_zips: Sequence[int] = ()) -> DataFrame:
    """The k highest- and k lowest-income ZIPs (ties by ZIP), NULL incomes and excluded ZIPs removed."""
    kept = exclude_keys(income.filter(F.col(f"`{INCOME}`").isNotNull()), ZIP, exclude_zips)
    return top_and_bottom_k(kept, INCOME, k, tie_break=[ZIP])


def dim_restricted_counts(facts: DataFrame, revgeo: DataFrame, income: DataFrame, year: int,
                          k: int = 3, exclude_zips: Sequence[int] = (),
                          labels: Mapping[str, str] = DESCENT_LABELS, strategy: str = "auto",
                          code_col: str = "Vict Descent", date_col: str = "DATE OCC") -> DataFrame:
    date_type = facts.schema[date_col].dataType.simpleString()
    year_facts = facts.filter(F.col(f"`{code_col}`").isNotNull()
                              & year_equals(F.col(f"`{date_col}`"), year, date_type))
    zips = income_extremes(income, k, exclude_zips).select(ZIP)
    restricted = restrict_by_dimension(year_facts, revgeo, zips, lookup_dim_key="ZIPcode", dim_key=ZIP,
                                       fact_keys=["LAT", "LON"], strategy=strategy)
    return (restricted.groupBy(code_label(F.col(f"`{code_col}`"), labels).alias("descent"))
            .agg(F.count(F.lit(1)).alias("victim_count"))
            .orderBy(F.desc("victim_count"), F.asc("descent")))


def code_label_counts(facts: DataFrame, labels: Mapping[str, str] = DESCENT_LABELS,
                      code_col: str = "Vict Descent") -> DataFrame:
    """Count per label of a code column (NULL codes form a NULL group)."""
    return (facts.groupBy(code_label(F.col(f"`{code_col}`"), labels).alias("descent"))
            .agg(F.count(F.lit(1)).alias("victim_count")))
