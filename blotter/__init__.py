"""blotter: incident and geospatial-lookup analytics as Spark DataFrame operators.

Every operator is a function from DataFrames to a lazy DataFrame built from
Spark's DataFrame / SQL primitives, so the work runs distributed and Catalyst
plans it. See README.md for the operator map.
"""

from .functions.scalars import code_label, format_money, haversine_km, hhmm, parse_money, part_of_day
from .functions.sql import register_sql_functions
from .operators.joins import join_with_strategy, restrict_by_dimension
from .operators.nearest import nearest_site
from .operators.profile import row_counts, schema_report
from .operators.rank import top_and_bottom_k, top_k_per_group
from .sources.csv import read_csv_strings, read_incidents, read_income, read_revgeo, read_stations, typed_select
from .sources.periods import union_all, union_periods

__all__ = [
    "code_label", "format_money", "haversine_km", "hhmm", "parse_money", "part_of_day",
    "register_sql_functions", "join_with_strategy", "restrict_by_dimension", "nearest_site",
    "row_counts", "schema_report", "top_and_bottom_k", "top_k_per_group", "read_csv_strings",
    "read_incidents", "read_income", "read_revgeo", "read_stations", "typed_select",
    "union_all", "union_periods",
]
