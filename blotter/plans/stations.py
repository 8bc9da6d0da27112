"""Q4: incidents and stations.

* 1a/1b: distance to the *responsible* station (equi-join area = precinct),
  per year for firearm incidents and per division for any weapon.
* 2a/2b: distance to the *nearest* station, per year (firearm) and per
  nearest division (any weapon). One result row per incident key: the
  reference groups the candidate pairs by incident number.

The station join carries the caller's strategy; ``auto`` leaves it to AQE. Nearest
uses the grid-candidate operator (no cross join), then a per-key step whose
``row_number() = 1`` filter is pre-limited per map task (``WindowGroupLimit``),
so a key holding a third of all rows never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import haversine_km
from ..functions.sql import HAVERSINE, drop_sql_functions, haversine_expr, register_sql_functions
from ..operators.filters import drop_missing, in_range
from ..operators.joins import DEFAULT_MAX_BROADCAST_BYTES, join_with_strategy
from ..operators.nearest import SiteGrid, candidate_rows, nearest_site, nearest_sites
from ..operators.rank import top_k_per_group
from ..operators.skew import salted_join
from ..sources.layout import bucketed

KEY, DATE, AREA, WEAPON = "DR_NO", "DATE OCC", "AREA", "Weapon Used Cd"
FIREARM = (100, 199)
DIGITS = 6


def _q(c: str) -> str:
    return f"`{c}`"


def firearm(incidents: DataFrame) -> DataFrame:
    return incidents.filter(in_range(WEAPON, *FIREARM))


def any_weapon(incidents: DataFrame) -> DataFrame:
    return incidents.filter(F.col(_q(WEAPON)).isNotNull())


def _station_side(stations: DataFrame) -> DataFrame:
    return stations.select("PREC", "DIVISION", "X", "Y")


def with_responsible_station(incidents: DataFrame, stations: DataFrame, strategy: str = "auto") -> DataFrame:
    """Incidents joined to the station of their area, with the distance to it (km)."""
    area = F.col(_q(AREA)).cast("bigint")
    if strategy == "salted":
        joined = salted_join(incidents, _station_side(stations), [area], [F.col("PREC")])
    else:
        joined = join_with_strategy(incidents, _station_side(stations), area == F.col("PREC"), "inner", strategy)
    return joined.withColumn("distance", haversine_km(F.col("LAT"), F.col("LON"), F.col("Y"), F.col("X")))


def _mean_and_count(df: DataFrame, group: str, counted: str) -> DataFrame:
    return df.groupBy(group).agg(F.round(F.avg("distance"), DIGITS).alias("mean_distance"),
                                 F.count(counted).alias("crime_count"))


def responsible_by_year(incidents: DataFrame, stations: DataFrame, strategy: str = "auto") -> DataFrame:
    joined = with_responsible_station(firearm(incidents), stations, strategy)
    return _mean_and_count(joined.withColumn("year", F.year(_q(DATE))), "year", "year").orderBy("year")


def responsible_by_year_bucketed(incidents: DataFrame, stations: DataFrame, buckets: int = 8) -> DataFrame:
    """From tables laid out by area: the join reads both sides bucket by bucket, without an exchange.

    The layout is written here; a caller with several questions writes it once
    (``sources.layout.bucketed``) and asks them all of it.
    """
    laid = bucketed(firearm(incidents).select(DATE, F.col(_q(AREA)).cast("bigint").alias(AREA), "LAT", "LON"), [AREA], buckets)
    at = bucketed(_station_side(stations), ["PREC"], buckets)
    return responsible_by_year_of_layout(laid, at)


def responsible_by_year_of_layout(laid: DataFrame, at: DataFrame) -> DataFrame:
    joined = laid.join(at.hint("merge"), F.col(_q(AREA)) == F.col("PREC"))
    far = joined.withColumn("distance", haversine_km(F.col("LAT"), F.col("LON"), F.col("Y"), F.col("X")))
    return _mean_and_count(far.withColumn("year", F.year(_q(DATE))), "year", "year").orderBy("year")


def responsible_by_division(incidents: DataFrame, stations: DataFrame, strategy: str = "auto") -> DataFrame:
    joined = with_responsible_station(any_weapon(incidents), stations, strategy)
    return (_mean_and_count(joined.withColumnRenamed("DIVISION", "division"), "division", "division")
            .orderBy(F.desc("crime_count"), "division"))


def responsible_distances(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    """Per incident: its responsible division and the distance to it."""
    joined = with_responsible_station(incidents, stations)
    return joined.select(F.col(KEY).alias("dr_no"), F.col("DIVISION").alias("division"),
                         F.round("distance", DIGITS).alias("distance"))


def responsible_by_year_sql(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    return incidents.sparkSession.sql(f"""
        WITH filtered AS (
            SELECT * FROM {{crimes}} WHERE `{WEAPON}` BETWEEN :lo AND :hi
        ), joined AS (
            SELECT year(f.`{DATE}`) AS year,
                   {haversine_expr('f.LAT', 'f.LON', 'p.Y', 'p.X')} AS distance
            FROM {{stations}} p JOIN filtered f ON p.PREC = CAST(f.`{AREA}` AS BIGINT)
        )
        SELECT year, ROUND(AVG(distance), {DIGITS}) AS mean_distance, COUNT(year) AS crime_count
        FROM joined GROUP BY year ORDER BY year
    """, args={"lo": FIREARM[0], "hi": FIREARM[1]}, crimes=incidents, stations=stations)


def responsible_by_division_sql(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    return incidents.sparkSession.sql(f"""
        WITH filtered AS (
            SELECT * FROM {{crimes}} WHERE `{WEAPON}` IS NOT NULL
        ), joined AS (
            SELECT p.DIVISION AS division,
                   {haversine_expr('f.LAT', 'f.LON', 'p.Y', 'p.X')} AS distance
            FROM {{stations}} p JOIN filtered f ON p.PREC = CAST(f.`{AREA}` AS BIGINT)
        )
        SELECT division, ROUND(AVG(distance), {DIGITS}) AS mean_distance, COUNT(division) AS crime_count
        FROM joined GROUP BY division ORDER BY crime_count DESC, division
    """, crimes=incidents, stations=stations)


def responsible_distances_sql(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    """Through the SQL function, which is dropped again once the plan holds its expression."""
    spark = incidents.sparkSession
    register_sql_functions(spark)
    out = spark.sql(f"""
        SELECT f.{KEY} AS dr_no, p.DIVISION AS division,
               ROUND({HAVERSINE}(f.LAT, f.LON, p.Y, p.X), {DIGITS}) AS distance
        FROM {{crimes}} f JOIN {{stations}} p ON p.PREC = CAST(f.`{AREA}` AS BIGINT)
    """, crimes=incidents, stations=stations)
    drop_sql_functions(spark)
    return out


# --- nearest station ------------------------------------------------------------------

def _usable_stations(stations: DataFrame) -> DataFrame:
    return drop_missing(stations, ["X", "Y"])


def nearest_per_key(incidents: DataFrame, stations: DataFrame, cover: DataFrame | None = None) -> DataFrame:
    """One row per incident key: (key, year, division, distance) of its nearest station.

    A key with several rows keeps its closest pair (ties by division), as the
    reference's rank-per-key does; NULL distances rank last. Incidents without
    usable coordinates keep a NULL station; with no usable station at all the
    result is empty, as pairing every incident with every station gives.
    """
    near = nearest_site(incidents.select(KEY, DATE, "LAT", "LON"), _usable_stations(stations),
                        site_cols=["DIVISION"], cover=cover, when_no_sites="drop")
    ranked = top_k_per_group(near, [KEY], [F.asc_nulls_last("distance"), F.asc_nulls_last("DIVISION")], 1,
                             rank_col="__rank")
    return ranked.select(KEY, F.year(_q(DATE)).alias("year"), F.col("DIVISION").alias("division"), "distance")


def nearest_distance_per_key(incidents: DataFrame, stations: DataFrame,
                             cover: DataFrame | None = None) -> DataFrame:
    """One row per incident key: (key, year, distance to its nearest station).

    Only the distance is needed, so the per-key step is a hash aggregate
    (partial per map task, then final) rather than a rank: a key holding a
    third of all rows is collapsed before the shuffle.
    """
    near = nearest_site(incidents.select(KEY, DATE, "LAT", "LON"), _usable_stations(stations),
                        site_cols=["DIVISION"], cover=cover, when_no_sites="drop")
    return near.groupBy(KEY).agg(F.min("distance").alias("distance"), F.min(F.year(_q(DATE))).alias("year"))


def nearest_by_year(incidents: DataFrame, stations: DataFrame, cover: DataFrame | None = None) -> DataFrame:
    per_key = nearest_distance_per_key(firearm(incidents), stations, cover)
    return _mean_and_count(per_key, "year", "year").orderBy("year")


def nearest_by_division(incidents: DataFrame, stations: DataFrame, cover: DataFrame | None = None) -> DataFrame:
    per_key = nearest_per_key(any_weapon(incidents), stations, cover)
    return _mean_and_count(per_key, "division", "division").orderBy(F.desc("crime_count"), "division")


def nearest_k_by_division(incidents: DataFrame, stations: DataFrame, k: int, cover: DataFrame | None = None) -> DataFrame:
    """Of incidents with a weapon: per division and rank (1 to ``k``), how many have it as their rank-th nearest, and how far.

    Incidents without usable coordinates have no nearest divisions and are left out.
    """
    near = nearest_sites(any_weapon(incidents).select("LAT", "LON"), _usable_stations(stations), k, cover=cover)
    told = near.select(F.posexplode("nearest").alias("place", "site"))
    return (told.groupBy(F.col("site.DIVISION").alias("division"), (F.col("place") + 1).alias("rank"))
            .agg(F.round(F.avg("site.distance"), DIGITS).alias("mean_distance"), F.count(F.lit(1)).alias("crime_count"))
            .orderBy("rank", F.desc("crime_count"), "division"))


def _nearest_sql_inputs(incidents: DataFrame, stations: DataFrame, cover: DataFrame | None,
                        cols: Sequence[str]) -> tuple[dict[str, DataFrame], str]:
    grid = SiteGrid.build(_usable_stations(stations), "Y", "X", ["DIVISION"])
    if grid.exponent is None:
        empty = stations.sparkSession.createDataFrame([], "__x0 bigint, __y0 bigint, __slat double, "
                                                          "__slon double, DIVISION string")
        pts = incidents.select(*cols).withColumns({"__x0": F.lit(None).cast("bigint"),
                                                    "__y0": F.lit(None).cast("bigint")}).filter(F.lit(False))
        return {"points": pts, "cands": empty}, ""
    pts = grid.assign_cells(incidents.select(*cols), "LAT", "LON")
    table, size = grid.candidate_table(cover if cover is not None else incidents, "LAT", "LON")
    hint = "BROADCAST" if size <= DEFAULT_MAX_BROADCAST_BYTES else "MERGE"
    return {"points": pts, "cands": candidate_rows(table)}, f"/*+ {hint}(c) */"


def nearest_by_year_sql(incidents: DataFrame, stations: DataFrame, cover: DataFrame | None = None) -> DataFrame:
    frames, hint = _nearest_sql_inputs(firearm(incidents), stations, cover, [KEY, DATE, "LAT", "LON"])
    return incidents.sparkSession.sql(f"""
        WITH pairs AS (
            SELECT {hint} p.{KEY}, year(p.`{DATE}`) AS year,
                   {haversine_expr('p.LAT', 'p.LON', 'c.__slat', 'c.__slon')} AS distance
            FROM {{points}} p LEFT JOIN {{cands}} c ON p.__x0 = c.__x0 AND p.__y0 = c.__y0
        ), per_key AS (
            SELECT {KEY}, MIN(distance) AS min_distance, MIN(year) AS year FROM pairs GROUP BY {KEY}
        )
        SELECT year, ROUND(AVG(min_distance), {DIGITS}) AS mean_distance, COUNT(year) AS crime_count
        FROM per_key GROUP BY year ORDER BY year
    """, **frames)


def nearest_by_division_sql(incidents: DataFrame, stations: DataFrame,
                            cover: DataFrame | None = None) -> DataFrame:
    frames, hint = _nearest_sql_inputs(any_weapon(incidents), stations, cover, [KEY, "LAT", "LON"])
    return incidents.sparkSession.sql(f"""
        WITH pairs AS (
            SELECT {hint} p.{KEY}, c.DIVISION AS division,
                   {haversine_expr('p.LAT', 'p.LON', 'c.__slat', 'c.__slon')} AS distance
            FROM {{points}} p LEFT JOIN {{cands}} c ON p.__x0 = c.__x0 AND p.__y0 = c.__y0
        ), ranked AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEY}
                                         ORDER BY distance ASC NULLS LAST, division ASC NULLS LAST) AS row_num
            FROM pairs
        )
        SELECT division, ROUND(AVG(distance), {DIGITS}) AS mean_distance, COUNT(division) AS crime_count
        FROM ranked WHERE row_num = 1 GROUP BY division ORDER BY crime_count DESC, division
    """, **frames)
