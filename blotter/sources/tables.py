"""Logical inputs derived from the generated Parquet tables.

The reference's CSV files are not available; these functions derive each
logical input (incidents, stations, income by ZIP, reverse geocode) from the
generated tables by a fixed, documented mapping. Everything stays lazy and
row-local, so Parquet column pruning and filter pushdown reach the scans.

Mapping (fixed values; changing any changes every query's result):

* incidents with a year  <- ``orders``:  DR_NO = o_orderkey (less 1 if 7 divides it, so two rows share a key),
  DATE OCC = o_orderdate (none if 101 divides the key), Date Rptd = o_orderdate + key % 45 days (none if 53 does),
  AREA = o_custkey % 27, Weapon Used Cd = o_orderkey % 400 (none if 11 divides it), no LAT if 97 divides the key,
  LAT = 33.7 + (o_orderkey * 7919 % 6000) / 10000,
  LON = -118.7 + (o_orderkey * 104729 % 6000) / 10000.
  Two period files: DATE OCC before 1999 or missing, and from 1998 on (1998 is in both).
* incidents with a clock time <- ``events``: TIME OCC = hour(ts) * 100 + minute(ts),
  Premis Desc = event_type (the premise 'STREET' is the event type 'click').
* stations <- ``nation``: PREC = n_nationkey, DIVISION = n_name, FID = n_nationkey,
  Y = 33.7 + (n_nationkey * 1237 % 600) / 1000, X = -118.7 + (n_nationkey * 2311 % 600) / 1000.
* income by ZIP <- ``supplier``: Zip Code = s_suppkey, Community = s_name,
  Estimated Median Income = money text of floor(s_acctbal).
* reverse geocode <- ``lineitem``: (LAT, LON) = (l_partkey, l_suppkey), ZIPcode = (l_partkey + l_suppkey) % 97 + 1.
* coded facts <- ``lineitem``: Vict Descent = code number l_partkey % 21 of 20 (else none), DATE OCC = l_shipdate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import format_money, hhmm

# --- fixed values of the mapping ---------------------------------------------------
AREA_MODULUS = 27
WEAPON_MODULUS = 400
INCIDENT_LAT = (33.7, 7919, 6000, 10000.0)
INCIDENT_LON = (-118.7, 104729, 6000, 10000.0)
STATION_Y = (33.7, 1237, 600, 1000.0)
STATION_X = (-118.7, 2311, 600, 1000.0)
PERIOD_A_BEFORE = "1999-01-01"
PERIOD_B_FROM = "1998-01-01"
STREET_EVENT = "click"
# Rows by key with a missing value, and keys that share the number before.
SHARED_KEY_EVERY, REPORT_DELAY_DAYS = 7, 45
NO_REPORT_DATE_EVERY, NO_DATE_EVERY, NO_WEAPON_EVERY, NO_LATITUDE_EVERY = 53, 101, 11, 97
ZIP_MODULUS = 97
# The 19 codes of the label table and one unknown code; every 21st fact has none.
FACT_CODES = ("A", "B", "C", "D", "F", "G", "H", "I", "J", "K", "L", "O", "P", "S", "U", "V", "W", "X", "Z", "Q")
# -----------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scaled(key: str, spec: tuple[float, int, int, float]):
    base, mult, mod, div = spec
    return F.lit(base) + (F.col(key) * mult % mod) / F.lit(div)


def incidents_from_orders(orders: DataFrame) -> DataFrame:
    """Typed incidents with the columns the year/area/weapon/location queries use."""
    key = F.col("o_orderkey")
    report_delay = F.make_dt_interval((key % REPORT_DELAY_DAYS).cast("int"))
    return orders.select(
        (key - F.when((key % SHARED_KEY_EVERY == 0) & (key > 0), 1).otherwise(0)).alias("DR_NO"),
        F.when(key % NO_REPORT_DATE_EVERY != 0, F.col("o_orderdate") + report_delay).alias("Date Rptd"),
        F.when(key % NO_DATE_EVERY != 0, F.col("o_orderdate")).alias("DATE OCC"),
        (F.col("o_custkey") % AREA_MODULUS).cast("int").alias("AREA"),
        F.when(key % NO_WEAPON_EVERY != 0, (key % WEAPON_MODULUS).cast("float")).alias("Weapon Used Cd"),
        F.when(key % NO_LATITUDE_EVERY != 0, _scaled("o_orderkey", INCIDENT_LAT)).alias("LAT"),
        _scaled("o_orderkey", INCIDENT_LON).alias("LON"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_orderpriority").alias("Crm Cd Desc"),
    )


def incident_periods(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The two overlapping period tables (rows of 1998 appear in both)."""
    inc = incidents_from_orders(table(spark, sf_dir, "orders"))
    return [inc.filter(F.col("DATE OCC").isNull() | (F.col("DATE OCC") < F.lit(PERIOD_A_BEFORE).cast("timestamp_ntz"))),
            inc.filter(F.col("DATE OCC") >= F.lit(PERIOD_B_FROM).cast("timestamp_ntz"))]


def clocked_incidents_from_events(events: DataFrame) -> DataFrame:
    """Incidents with an HHMM clock and a premise."""
    return events.select(
        F.col("event_id").alias("DR_NO"),
        hhmm("ts").alias("TIME OCC"),
        F.col("event_type").alias("Premis Desc"),
    )


def stations_from_nation(nation: DataFrame) -> DataFrame:
    return nation.select(
        _scaled("n_nationkey", STATION_X).alias("X"),
        _scaled("n_nationkey", STATION_Y).alias("Y"),
        F.col("n_nationkey").cast("int").alias("FID"),
        F.col("n_name").alias("DIVISION"),
        F.concat(F.col("n_nationkey").cast("string"), F.lit(" Station St")).alias("LOCATION"),
        F.col("n_nationkey").cast("bigint").alias("PREC"),
    )


def income_text_from_supplier(supplier: DataFrame) -> DataFrame:
    """Income by ZIP with the income still as money text (``"$1,234"``)."""
    return supplier.select(
        F.col("s_suppkey").alias("Zip Code"),
        F.col("s_name").alias("Community"),
        format_money(F.floor("s_acctbal")).alias("Estimated Median Income"),
    )


def revgeo_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Reverse geocode rows, duplicates included (dedupe happens after restriction)."""
    return lineitem.select(
        F.col("l_partkey").cast("double").alias("LAT"),
        F.col("l_suppkey").cast("double").alias("LON"),
        ((F.col("l_partkey") + F.col("l_suppkey")) % ZIP_MODULUS + 1).alias("ZIPcode"),
    )


def coded_facts_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Facts with a code, a date and the composite key shared with the reverse geocode."""
    return lineitem.select(
        F.col("l_partkey").cast("double").alias("LAT"),
        F.col("l_suppkey").cast("double").alias("LON"),
        F.try_element_at(F.array(*[F.lit(c) for c in FACT_CODES]),
                         (F.col("l_partkey") % (len(FACT_CODES) + 1) + 1).cast("int")).alias("Vict Descent"),
        F.col("l_shipdate").alias("DATE OCC"),
    )
