"""Schemas of the inputs: incident period files and three dimension files.

Raw files are read with every field as a string (names from the header line);
these StructTypes are the *typed* targets that ``sources.csv.typed_select``
casts to, tolerantly (``try_cast``), by column name.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Timestamp text pattern of the incident files (12-hour clock with AM/PM).
INCIDENT_TS_PATTERN = "MM/dd/yyyy hh:mm:ss a"


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


# Incident table, 28 columns, in file order.
INCIDENT = _fields(
    ("DR_NO", T.LongType()),
    ("Date Rptd", T.TimestampType()),
    ("DATE OCC", T.TimestampType()),
    ("TIME OCC", T.IntegerType()),
    ("AREA", T.IntegerType()),
    ("AREA NAME", T.StringType()),
    ("Rpt Dist No", T.IntegerType()),
    ("Part 1-2", T.IntegerType()),
    ("Crm Cd", T.IntegerType()),
    ("Crm Cd Desc", T.StringType()),
    ("Mocodes", T.StringType()),
    ("Vict Age", T.IntegerType()),
    ("Vict Sex", T.StringType()),
    ("Vict Descent", T.StringType()),
    ("Premis Cd", T.FloatType()),
    ("Premis Desc", T.StringType()),
    ("Weapon Used Cd", T.FloatType()),
    ("Weapon Desc", T.StringType()),
    ("Status", T.StringType()),
    ("Status Desc", T.StringType()),
    ("Crm Cd 1", T.FloatType()),
    ("Crm Cd 2", T.FloatType()),
    ("Crm Cd 3", T.FloatType()),
    ("Crm Cd 4", T.FloatType()),
    ("LOCATION", T.StringType()),
    ("Cross Street", T.StringType()),
    ("LAT", T.DoubleType()),
    ("LON", T.DoubleType()),
)

# Median income by ZIP; the income field is money text ("$12,000").
INCOME = _fields(
    ("Zip Code", T.LongType()),
    ("Community", T.StringType()),
    ("Estimated Median Income", T.IntegerType()),
)

# Reverse geocoding: coordinate pair -> ZIP.
REVGEO = _fields(
    ("LAT", T.DoubleType()),
    ("LON", T.DoubleType()),
    ("ZIPcode", T.LongType()),
)

# Stations: X = longitude, Y = latitude.
STATION = _fields(
    ("X", T.DoubleType()),
    ("Y", T.DoubleType()),
    ("FID", T.IntegerType()),
    ("DIVISION", T.StringType()),
    ("LOCATION", T.StringType()),
    ("PREC", T.LongType()),
)

# Columns whose text is a timestamp in INCIDENT_TS_PATTERN.
TIMESTAMP_PATTERNS = {"Date Rptd": INCIDENT_TS_PATTERN, "DATE OCC": INCIDENT_TS_PATTERN}

# Columns whose text is money.
MONEY_COLUMNS = ("Estimated Median Income",)
