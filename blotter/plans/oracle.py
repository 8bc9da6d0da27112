"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly against the generated tables, with the same fixed mapping
as ``sources.tables`` spelled out in SQL. Nearest-station queries are
brute force here (every incident against every station), the plain
definition the Spark operator must reproduce.
"""

from __future__ import annotations

# --- the mapping's values, spelled out again: nothing is taken from the code under test ---
STRATEGIES = ("broadcast", "merge", "shuffle_hash")
EXCLUDED_ZIPS = (3, 7)
FACT_CODES = ["A", "B", "C", "D", "F", "G", "H", "I", "J", "K", "L", "O", "P", "S", "U", "V", "W", "X", "Z", "Q"]
LABELS = {
    "A": "Other Asian", "B": "Black", "C": "Chinese", "D": "Cambodian", "F": "Filipino", "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican", "I": "American Indian/Alaskan Native", "J": "Japanese", "K": "Korean",
    "L": "Laotian", "O": "Other", "P": "Pacific Islander", "S": "Samoan", "U": "Hawaiian", "V": "Vietnamese",
    "W": "White", "X": "Unknown", "Z": "Asian Indian",
}
# -------------------------------------------------------------------------------------------


def _scaled(key: str, base: float, mult: int, mod: int, div: float) -> str:
    return f"({base}::DOUBLE + ({key} * {mult} % {mod}) / {div}::DOUBLE)"


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)")
    return (f"(2 * asin(CASE WHEN sqrt({a}) > 1 THEN 1.0::DOUBLE ELSE sqrt({a}) END)"
            f" * 6371::DOUBLE)")


INCIDENTS = f"""
inc_all AS (
    SELECT o_orderkey - CASE WHEN o_orderkey % 7 = 0 AND o_orderkey > 0 THEN 1 ELSE 0 END AS "DR_NO",
           CASE WHEN o_orderkey % 53 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 45 AS INTEGER)) END AS "Date Rptd",
           CASE WHEN o_orderkey % 101 <> 0 THEN o_orderdate END AS "DATE OCC",
           CAST(o_custkey % 27 AS INTEGER) AS "AREA",
           CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 400 AS FLOAT) END AS "Weapon Used Cd",
           CASE WHEN o_orderkey % 97 <> 0 THEN {_scaled('o_orderkey', 33.7, 7919, 6000, 10000.0)} END AS "LAT",
           {_scaled('o_orderkey', -118.7, 104729, 6000, 10000.0)} AS "LON",
           o_orderstatus AS "Status", o_orderpriority AS "Crm Cd Desc"
    FROM orders
), p1 AS (
    SELECT * FROM inc_all WHERE "DATE OCC" IS NULL OR "DATE OCC" < TIMESTAMP '1999-01-01'
), p2 AS (
    SELECT * FROM inc_all WHERE "DATE OCC" >= TIMESTAMP '1998-01-01'
), inc AS (
    SELECT * FROM p1 UNION SELECT * FROM p2
)"""

STATIONS = f"""
st AS (
    SELECT {_scaled('n_nationkey', -118.7, 2311, 600, 1000.0)} AS "X", {_scaled('n_nationkey', 33.7, 1237, 600, 1000.0)} AS "Y",
           CAST(n_nationkey AS INTEGER) AS "FID", n_name AS "DIVISION", n_nationkey || ' Station St' AS "LOCATION",
           CAST(n_nationkey AS BIGINT) AS "PREC"
    FROM nation
)"""

MONEY_TEXT = "('$' || format('{:,}', CAST(floor(s_acctbal) AS BIGINT)))"
INCOME = f"""
income AS (
    SELECT s_suppkey AS zip, s_acctbal,
           TRY_CAST(regexp_replace({MONEY_TEXT}, '[$,]', '', 'g') AS INTEGER) AS income
    FROM supplier
)"""

_excl = " OR ".join(f"zip = {z}" for z in EXCLUDED_ZIPS)
EXTREMES = f"""
kept AS (
    SELECT * FROM income WHERE income IS NOT NULL AND NOT ({_excl})
), extremes AS (
    (SELECT zip, income FROM kept ORDER BY income DESC, zip LIMIT 3)
    UNION ALL
    (SELECT zip, income FROM kept ORDER BY income ASC, zip LIMIT 3)
)"""


def _label(code: str, labels: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE WHEN {code} IS NOT NULL THEN COALESCE(CASE {code} {arms} END, {code}) END"


CODE = f"({FACT_CODES})[CAST(l_partkey % 21 + 1 AS INTEGER)]"

CLOCK_BUCKET = """CASE WHEN clock BETWEEN 500 AND 1159 THEN 'Morning'
     WHEN clock BETWEEN 1200 AND 1659 THEN 'Afternoon'
     WHEN clock BETWEEN 1700 AND 2059 THEN 'Evening'
     WHEN clock >= 2100 OR clock <= 359 THEN 'Night' END"""

TS_FMT = "%m/%d/%Y %I:%M:%S %p"

_schema_cols = [("DR_NO", "bigint"), ("Date Rptd", "timestamp_ntz"), ("DATE OCC", "timestamp_ntz"), ("AREA", "int"),
                ("Weapon Used Cd", "float"), ("LAT", "double"), ("LON", "double"),
                ("Status", "string"), ("Crm Cd Desc", "string")]
SCHEMA_REPORT = f"WITH {INCIDENTS}\n" + "\nUNION ALL\n".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS position, '{n}' AS column_name, '{t}' AS data_type, "
    f"TRUE AS nullable, COUNT(\"{n}\") AS non_null_count FROM inc"
    for i, (n, t) in enumerate(_schema_cols))

PART_OF_DAY = f"""
WITH e AS (SELECT CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS clock, event_type FROM events)
SELECT {CLOCK_BUCKET} AS part_of_day, COUNT(*) AS crime_count
FROM e WHERE event_type = 'click' GROUP BY 1
"""

TOP_MONTHS_SQL = f"""
WITH {INCIDENTS}, monthly AS (
    SELECT CAST(year("Date Rptd") AS INTEGER) AS year, CAST(month("Date Rptd") AS INTEGER) AS month,
           COUNT(*) AS crime_total
    FROM inc WHERE "Date Rptd" IS NOT NULL AND "DATE OCC" IS NOT NULL GROUP BY 1, 2
), ranked AS (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY year ORDER BY crime_total DESC, month) AS INTEGER) AS "rank"
    FROM monthly
)
SELECT year, month, crime_total, "rank" FROM ranked WHERE "rank" <= 3
"""

DESCENT = f"""
WITH {INCOME}, {EXTREMES}, pairs AS (
    SELECT DISTINCT CAST(l_partkey AS DOUBLE) AS lat, CAST(l_suppkey AS DOUBLE) AS lon
    FROM lineitem JOIN extremes ON (l_partkey + l_suppkey) % 97 + 1 = extremes.zip
), facts AS (
    SELECT CAST(l_partkey AS DOUBLE) AS lat, CAST(l_suppkey AS DOUBLE) AS lon, {CODE} AS code
    FROM lineitem
    WHERE {CODE} IS NOT NULL
      AND l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
)
SELECT {_label('code', LABELS)} AS descent, COUNT(*) AS victim_count
FROM facts f JOIN pairs p ON f.lat = p.lat AND f.lon = p.lon
GROUP BY 1
"""

RESPONSIBLE_BY_YEAR = f"""
WITH {INCIDENTS}, {STATIONS}
SELECT CAST(year(f."DATE OCC") AS INTEGER) AS year,
       round(avg({_hav('f."LAT"', 'f."LON"', 'p."Y"', 'p."X"')}), 6) AS mean_distance,
       COUNT(year(f."DATE OCC")) AS crime_count
FROM st p JOIN inc f ON p."PREC" = CAST(f."AREA" AS BIGINT)
WHERE f."Weapon Used Cd" BETWEEN 100 AND 199
GROUP BY 1
"""

RESPONSIBLE_BY_DIVISION = f"""
WITH {INCIDENTS}, {STATIONS}
SELECT p."DIVISION" AS division,
       round(avg({_hav('f."LAT"', 'f."LON"', 'p."Y"', 'p."X"')}), 6) AS mean_distance,
       COUNT(p."DIVISION") AS crime_count
FROM st p JOIN inc f ON p."PREC" = CAST(f."AREA" AS BIGINT)
WHERE f."Weapon Used Cd" IS NOT NULL
GROUP BY 1
"""

RESPONSIBLE_DISTANCES = f"""
WITH {INCIDENTS}, {STATIONS}
SELECT f."DR_NO" AS dr_no, p."DIVISION" AS division,
       round({_hav('f."LAT"', 'f."LON"', 'p."Y"', 'p."X"')}, 6) AS distance
FROM inc f JOIN st p ON p."PREC" = CAST(f."AREA" AS BIGINT)
"""

_USABLE = 'st."X" IS NOT NULL AND st."Y" IS NOT NULL AND NOT isnan(st."X") AND NOT isnan(st."Y") AND f."LAT" IS NOT NULL AND f."LON" IS NOT NULL'

NEAREST_BY_YEAR = f"""
WITH {INCIDENTS}, {STATIONS}, pairs AS (
    SELECT f."DR_NO" AS k, year(f."DATE OCC") AS year,
           {_hav('f."LAT"', 'f."LON"', 'st."Y"', 'st."X"')} AS distance
    FROM inc f LEFT JOIN st ON {_USABLE}
    WHERE f."Weapon Used Cd" BETWEEN 100 AND 199
), per_key AS (
    SELECT k, min(distance) AS distance, min(year) AS year FROM pairs GROUP BY k
)
SELECT CAST(year AS INTEGER) AS year, round(avg(distance), 6) AS mean_distance, COUNT(year) AS crime_count
FROM per_key GROUP BY 1
"""

NEAREST_BY_DIVISION = f"""
WITH {INCIDENTS}, {STATIONS}, pairs AS (
    SELECT f."DR_NO" AS k, st."DIVISION" AS division,
           {_hav('f."LAT"', 'f."LON"', 'st."Y"', 'st."X"')} AS distance
    FROM inc f LEFT JOIN st ON {_USABLE}
    WHERE f."Weapon Used Cd" IS NOT NULL
), ranked AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY distance, division) AS rn FROM pairs
)
SELECT division, round(avg(distance), 6) AS mean_distance, COUNT(division) AS crime_count
FROM ranked WHERE rn = 1 GROUP BY 1
"""

NEAREST_K = f"""
WITH {INCIDENTS}, {STATIONS}, numbered AS (
    SELECT *, row_number() OVER () AS n FROM inc WHERE "Weapon Used Cd" IS NOT NULL
), ranked AS (
    SELECT st."DIVISION" AS division, distance,
           ROW_NUMBER() OVER (PARTITION BY n ORDER BY distance, st."DIVISION") AS "rank"
    FROM (SELECT f.n, st."DIVISION", {_hav('f."LAT"', 'f."LON"', 'st."Y"', 'st."X"')} AS distance
          FROM numbered f JOIN st ON {_USABLE}) st
)
SELECT division, CAST("rank" AS INTEGER) AS "rank", round(avg(distance), 6) AS mean_distance, COUNT(*) AS crime_count
FROM ranked WHERE "rank" <= 3 GROUP BY 1, 2
"""

ORACLE_SQL: dict[str, str] = {
    "profile_count": f"""
        WITH {INCIDENTS}
        SELECT 'period_1' AS "table", COUNT(*) AS row_count FROM p1
        UNION ALL SELECT 'period_2', COUNT(*) FROM p2
        UNION ALL SELECT 'incidents', COUNT(*) FROM inc""",
    "schema_report": SCHEMA_REPORT,
    "csv_roundtrip": "SELECT * FROM part",
    "csv_file_roundtrip": "SELECT * FROM part",
    "csv_incident_files": f"WITH {INCIDENTS} SELECT * FROM inc",
    "csv_mixed_headers": f"WITH {INCIDENTS} SELECT * FROM inc",
    "csv_narrow_read": f"""WITH {INCIDENTS}, both_periods AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2)
        SELECT DISTINCT "DR_NO", "Date Rptd", "DATE OCC", "AREA", "LAT" FROM both_periods""",
    "csv_rejects": f"""
        WITH {INCIDENTS}, both_periods AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2)
        SELECT CASE WHEN "DR_NO" % 13 = 0 THEN 'Weapon Used Cd' END AS field, TRUE AS others_kept, FALSE AS broken_line,
               COUNT(*) AS row_count FROM both_periods GROUP BY 1""",
    "csv_income_file": f"""WITH {INCOME} SELECT zip AS "Zip Code", s_name AS "Community", income AS "Estimated Median Income"
        FROM income JOIN supplier ON zip = s_suppkey""",
    "csv_revgeo_file": """SELECT CAST(l_partkey AS DOUBLE) AS "LAT", CAST(l_suppkey AS DOUBLE) AS "LON",
        (l_partkey + l_suppkey) % 97 + 1 AS "ZIPcode" FROM lineitem""",
    "csv_station_file": f"WITH {STATIONS} SELECT * FROM st",
    "parse_timestamp": f"""
        WITH {INCIDENTS}, staged AS (SELECT "DR_NO" AS dr_no, strftime("DATE OCC", '{TS_FMT}') AS date_text FROM inc_all)
        SELECT *, strptime(date_text, '{TS_FMT}') AS occurred, CAST(strptime(date_text, '{TS_FMT}') AS DATE) AS occurred_date
        FROM staged""",
    "parse_money": f"WITH {INCOME} SELECT zip AS zip_code, income FROM income",
    "union_distinct": f"WITH {INCIDENTS} SELECT * FROM inc",
    "union_distinct_fingerprint": f"WITH {INCIDENTS} SELECT * FROM inc",
    "union_all_topk_bottomk": f"WITH {INCOME}, {EXTREMES} SELECT zip AS zip_code, income FROM extremes",
    "union_fold": f"""
        WITH {INCIDENTS}
        SELECT *, 'period_1' AS period FROM p1 UNION ALL SELECT *, 'period_2' AS period FROM p2""",
    "filter_not_null_range": f"""
        WITH {INCIDENTS}, marred AS (
            SELECT * REPLACE (CASE WHEN "DR_NO" % 89 <> 0 THEN "LON" ELSE 'nan'::DOUBLE END AS "LON") FROM inc)
        SELECT "DR_NO", "Weapon Used Cd", "LAT", "LON" FROM marred
        WHERE "Weapon Used Cd" BETWEEN 100 AND 199
          AND "LAT" IS NOT NULL AND "LON" IS NOT NULL AND NOT isnan("LAT") AND NOT isnan("LON")""",
    "filter_exclude_set": f"""
        WITH {INCOME}, injected AS (
            SELECT CASE WHEN s_acctbal >= 0 THEN zip END AS zip, income FROM income
        )
        SELECT zip AS zip_code, income FROM injected WHERE NOT ({_excl})""",
    "street_by_part_of_day": PART_OF_DAY,
    "street_by_part_of_day_sql": PART_OF_DAY,
    "street_by_part_of_day_rdd": PART_OF_DAY,
    "street_by_part_of_day_arrow": PART_OF_DAY,
    "top_months_per_year": TOP_MONTHS_SQL,
    "top_months_per_year_sql": TOP_MONTHS_SQL,
    "code_label_counts": f"""
        SELECT {_label(CODE, LABELS)} AS descent, COUNT(*) AS victim_count
        FROM lineitem GROUP BY 1""",
    "dim_restricted_counts": DESCENT,
    **{f"dim_restricted_counts_{s}": DESCENT for s in (*STRATEGIES, "bloom")},
    "haversine_pairs": RESPONSIBLE_DISTANCES,
    "haversine_sql_function": RESPONSIBLE_DISTANCES,
    "responsible_by_year": RESPONSIBLE_BY_YEAR,
    "responsible_by_year_sql": RESPONSIBLE_BY_YEAR,
    **{f"responsible_by_year_{s}": RESPONSIBLE_BY_YEAR for s in (*STRATEGIES, "salted", "bucketed")},
    "responsible_by_division": RESPONSIBLE_BY_DIVISION,
    "responsible_by_division_sql": RESPONSIBLE_BY_DIVISION,
    "nearest_by_year": NEAREST_BY_YEAR,
    "nearest_by_year_sql": NEAREST_BY_YEAR,
    "nearest_by_division": NEAREST_BY_DIVISION,
    "nearest_by_division_sql": NEAREST_BY_DIVISION,
    "nearest_k_by_division": NEAREST_K,
}
