"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads whole generated tables through the mapping of
``sources.tables``; nothing is sampled, capped or subset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables as tb
from ..sources.csv import read_income, read_revgeo, read_stations
from ..sources.periods import union_periods
from . import descent, ingest, months, part_of_day, stations

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed parameters of the registered queries -------------------------------------
DESCENT_YEAR = 1998
EXTREME_K = 3
EXCLUDED_ZIPS = (3, 7)
TOP_MONTHS = 3
NEAREST_K = 3
STREET = tb.STREET_EVENT
NARROW = ("DR_NO", "Date Rptd", "DATE OCC", "AREA", "LAT")
# -------------------------------------------------------------------------------------


def _incidents(spark: SparkSession, sf: str) -> DataFrame:
    return union_periods(tb.incident_periods(spark, sf))


def _cover(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinates of every incident row before de-duplication (a 2-column scan)."""
    return tb.incidents_from_orders(tb.table(spark, sf, "orders")).select("LAT", "LON")


def _stations(spark: SparkSession, sf: str) -> DataFrame:
    return tb.stations_from_nation(tb.table(spark, sf, "nation"))


def _income(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.typed_income(tb.income_text_from_supplier(tb.table(spark, sf, "supplier")))


def _clocked(spark: SparkSession, sf: str) -> DataFrame:
    return tb.clocked_incidents_from_events(tb.table(spark, sf, "events"))


def _descent(strategy: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        li = tb.table(spark, sf, "lineitem")
        return descent.dim_restricted_counts(
            tb.coded_facts_from_lineitem(li), tb.revgeo_from_lineitem(li), _income(spark, sf),
            year=DESCENT_YEAR, k=EXTREME_K, exclude_zips=EXCLUDED_ZIPS,
            strategy=strategy)
    return run


def _responsible_by_year(strategy: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return stations.responsible_by_year(_incidents(spark, sf), _stations(spark, sf), strategy)
    return run


def _income_with_missing_zips(spark: SparkSession, sf: str) -> DataFrame:
    """Income rows whose ZIP is unknown (NULL) where the balance is negative."""
    supplier = tb.table(spark, sf, "supplier")
    known = supplier.withColumn("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")))
    return ingest.typed_income(tb.income_text_from_supplier(known))


def _incidents_with_nan(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents of which every 89th has NaN for its longitude."""
    return _incidents(spark, sf).withColumn("LON", F.when(F.col("DR_NO") % 89 != 0, F.col("LON")).otherwise(F.lit(float("nan"))))


STRATEGIES = ("broadcast", "merge", "shuffle_hash")

QUERIES: dict[str, Query] = {
    # Q0 and ingest-level operators
    "profile_count": lambda s, d: ingest.profile_counts(tb.incident_periods(s, d)),
    "schema_report": lambda s, d: ingest.incidents_schema_report(tb.incident_periods(s, d)),
    "csv_roundtrip": lambda s, d: ingest.csv_roundtrip(tb.table(s, d, "part")),
    "csv_file_roundtrip": lambda s, d: ingest.csv_file_roundtrip_report(tb.table(s, d, "part")),
    "csv_incident_files": lambda s, d: ingest.incident_files(tb.incident_periods(s, d)),
    "csv_mixed_headers": lambda s, d: ingest.mixed_header_files(tb.incident_periods(s, d)),
    "csv_narrow_read": lambda s, d: ingest.mixed_header_files(tb.incident_periods(s, d), NARROW),
    "csv_rejects": lambda s, d: ingest.rejected_fields(tb.incident_periods(s, d)),
    "csv_income_file": lambda s, d: ingest.dimension_file(
        tb.income_text_from_supplier(tb.table(s, d, "supplier")), read_income),
    "csv_revgeo_file": lambda s, d: ingest.dimension_file(
        tb.revgeo_from_lineitem(tb.table(s, d, "lineitem")), read_revgeo),
    "csv_station_file": lambda s, d: ingest.dimension_file(_stations(s, d), read_stations),
    "parse_timestamp": lambda s, d: ingest.parse_timestamp_report(
        tb.incidents_from_orders(tb.table(s, d, "orders"))),
    "parse_money": lambda s, d: ingest.parse_money_report(tb.income_text_from_supplier(tb.table(s, d, "supplier"))),
    "union_distinct": _incidents,
    "union_distinct_fingerprint": lambda s, d: union_periods(tb.incident_periods(s, d), by_fingerprint=True),
    "union_all_topk_bottomk": lambda s, d: descent.income_extremes(_income(s, d), EXTREME_K, EXCLUDED_ZIPS).select(
        F.col("`Zip Code`").alias("zip_code"), F.col("`Estimated Median Income`").alias("income")),
    "union_fold": lambda s, d: ingest.union_fold(tb.incident_periods(s, d)),
    "filter_not_null_range": lambda s, d: ingest.located_firearm_incidents(_incidents_with_nan(s, d)),
    "filter_exclude_set": lambda s, d: ingest.income_without(_income_with_missing_zips(s, d), EXCLUDED_ZIPS),
    # Q2
    "street_by_part_of_day": lambda s, d: part_of_day.street_by_part_of_day(_clocked(s, d), STREET),
    "street_by_part_of_day_sql": lambda s, d: part_of_day.street_by_part_of_day_sql(_clocked(s, d), STREET),
    "street_by_part_of_day_rdd": lambda s, d: part_of_day.street_by_part_of_day_rdd(_clocked(s, d), STREET),
    "street_by_part_of_day_arrow": lambda s, d: part_of_day.street_by_part_of_day_arrow(_clocked(s, d), STREET),
    # Q1
    "top_months_per_year": lambda s, d: months.top_months_per_year(_incidents(s, d), TOP_MONTHS),
    "top_months_per_year_sql": lambda s, d: months.top_months_per_year_sql(_incidents(s, d), TOP_MONTHS),
    # Q3
    "code_label_counts": lambda s, d: descent.code_label_counts(
        tb.coded_facts_from_lineitem(tb.table(s, d, "lineitem"))),
    "dim_restricted_counts": _descent("auto"),
    **{f"dim_restricted_counts_{st}": _descent(st) for st in (*STRATEGIES, "bloom")},
    # Q4 distances
    "haversine_pairs": lambda s, d: stations.responsible_distances(_incidents(s, d), _stations(s, d)),
    "haversine_sql_function": lambda s, d: stations.responsible_distances_sql(_incidents(s, d), _stations(s, d)),
    # Q4-1a / 1b
    "responsible_by_year": _responsible_by_year("auto"),
    "responsible_by_year_sql": lambda s, d: stations.responsible_by_year_sql(_incidents(s, d), _stations(s, d)),
    **{f"responsible_by_year_{st}": _responsible_by_year(st) for st in (*STRATEGIES, "salted")},
    "responsible_by_year_bucketed": lambda s, d: stations.responsible_by_year_bucketed(_incidents(s, d), _stations(s, d)),
    "responsible_by_division": lambda s, d: stations.responsible_by_division(_incidents(s, d), _stations(s, d)),
    "responsible_by_division_sql": lambda s, d: stations.responsible_by_division_sql(
        _incidents(s, d), _stations(s, d)),
    # Q4-2a / 2b
    "nearest_by_year": lambda s, d: stations.nearest_by_year(_incidents(s, d), _stations(s, d), _cover(s, d)),
    "nearest_by_year_sql": lambda s, d: stations.nearest_by_year_sql(_incidents(s, d), _stations(s, d), _cover(s, d)),
    "nearest_by_division": lambda s, d: stations.nearest_by_division(_incidents(s, d), _stations(s, d), _cover(s, d)),
    "nearest_k_by_division": lambda s, d: stations.nearest_k_by_division(_incidents(s, d), _stations(s, d), NEAREST_K, _cover(s, d)),
    "nearest_by_division_sql": lambda s, d: stations.nearest_by_division_sql(
        _incidents(s, d), _stations(s, d), _cover(s, d)),
}
