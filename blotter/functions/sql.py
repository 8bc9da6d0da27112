"""SQL twins of the scalar expressions, registered as SQL functions.

``CREATE TEMPORARY FUNCTION .. RETURN <expr>`` defines a SQL UDF that Catalyst
inlines into the plan, so SQL queries calling it stay in codegen (no Python
worker, unlike a registered Python UDF).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalars import EARTH_RADIUS_KM, NIGHT_FROM, NIGHT_LABEL, NIGHT_UNTIL, PART_OF_DAY_RANGES

HAVERSINE, PART_OF_DAY = "blotter_haversine_km", "blotter_part_of_day"


def haversine_expr(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """SQL text of the great-circle distance in km."""
    root = (f"sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"2 * asin(CASE WHEN {root} > 1 THEN 1.0D ELSE {root} END) * {EARTH_RADIUS_KM}D"


def part_of_day_expr(clock: str) -> str:
    """SQL text of the part of day of an HHMM clock."""
    arms = " ".join(f"WHEN {clock} BETWEEN {lo} AND {hi} THEN '{label}'" for label, lo, hi in PART_OF_DAY_RANGES)
    return f"CASE {arms} WHEN {clock} >= {NIGHT_FROM} OR {clock} <= {NIGHT_UNTIL} THEN '{NIGHT_LABEL}' END"


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``blotter_haversine_km`` and ``blotter_part_of_day`` for this session's SQL."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {HAVERSINE}(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) "
              f"RETURNS DOUBLE RETURN {haversine_expr('lat1', 'lon1', 'lat2', 'lon2')}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {PART_OF_DAY}(clock INT) RETURNS STRING RETURN {part_of_day_expr('clock')}")


def drop_sql_functions(spark: SparkSession) -> None:
    """Drop them again; DataFrames already analysed keep the inlined expressions."""
    for name in (HAVERSINE, PART_OF_DAY):
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
