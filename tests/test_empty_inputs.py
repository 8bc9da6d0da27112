"""Every operator on empty input returns an empty (or zero-count) result with a stable schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from blotter.operators import joins
from blotter.operators.nearest import nearest_site
from blotter.operators.profile import row_counts, schema_report
from blotter.operators.rank import top_and_bottom_k, top_k_per_group
from blotter.plans import months, part_of_day, stations
from blotter.sources.periods import union_periods

INCIDENTS = "DR_NO bigint, `Date Rptd` timestamp_ntz, `DATE OCC` timestamp_ntz, `TIME OCC` int, `Premis Desc` string, AREA int, " \
            "`Weapon Used Cd` float, LAT double, LON double"
STATIONS = "X double, Y double, FID int, DIVISION string, LOCATION string, PREC bigint"


def test_empty_incidents_through_every_plan(spark):
    inc = spark.createDataFrame([], INCIDENTS)
    st = spark.createDataFrame([(-118.25, 34.05, 1, "ALPHA", "x", 1)], STATIONS)
    assert union_periods([inc, inc]).count() == 0
    assert part_of_day.street_by_part_of_day(inc).count() == 0
    assert part_of_day.street_by_part_of_day_rdd(inc).count() == 0
    assert months.top_months_per_year(inc).count() == 0
    assert stations.responsible_by_year(inc, st).count() == 0
    assert stations.nearest_by_division(inc, st).count() == 0
    assert stations.nearest_by_division_sql(inc, st).count() == 0


def test_empty_stations(spark):
    inc = spark.createDataFrame([(1, None, None, 100, "STREET", 1, 150.0, 34.0, -118.0)], INCIDENTS)
    st = spark.createDataFrame([], STATIONS)
    assert stations.responsible_by_division(inc, st).count() == 0
    # no station at all: no incident is paired, as with every-incident-by-every-station pairing
    assert stations.nearest_by_year(inc, st).count() == 0
    assert stations.nearest_by_year_sql(inc, st).count() == 0
    assert stations.nearest_by_division(inc, st).count() == 0


def test_empty_rank_profile_and_joins(spark):
    df = spark.createDataFrame([], "g int, v int")
    assert top_k_per_group(df, ["g"], [F.desc("v")], 3).count() == 0
    assert top_and_bottom_k(df, "v", 3).count() == 0
    assert [tuple(r) for r in row_counts([("t", df)]).collect()] == [("t", 0)]
    assert [tuple(r) for r in schema_report(df).collect()] == [(1, "g", "int", True, 0), (2, "v", "int", True, 0)]
    for st in joins.STRATEGIES:
        assert joins.join_with_strategy(df, df.withColumnRenamed("g", "h"), F.col("g") == F.col("h"),
                                        strategy=st).count() == 0


def test_nearest_without_sites_keeps_or_drops(spark):
    pts = spark.createDataFrame([(1, 1.0, 2.0)], "pid bigint, LAT double, LON double")
    sites = spark.createDataFrame([("A", None, None)], "DIVISION string, Y double, X double")
    assert [tuple(r) for r in nearest_site(pts, sites).collect()] == [(1, 1.0, 2.0, None, None)]
    assert nearest_site(pts, sites, when_no_sites="drop").count() == 0


def test_nearest_with_empty_points(spark):
    pts = spark.createDataFrame([], "pid bigint, LAT double, LON double")
    sites = spark.createDataFrame([("A", 1.0, 2.0)], "DIVISION string, Y double, X double")
    out = nearest_site(pts, sites)
    assert out.count() == 0 and out.columns == ["pid", "LAT", "LON", "DIVISION", "distance"]


def test_null_coordinates_counted_but_not_averaged(spark):
    import datetime as dt

    from .test_nearest import _hav

    inc = spark.createDataFrame([
        (1, None, dt.datetime(2015, 1, 1), 100, "STREET", 1, 150.0, 34.0, -118.0),
        (2, None, dt.datetime(2015, 2, 1), 100, "STREET", 1, 150.0, None, None),
        (3, None, dt.datetime(2016, 1, 1), 100, "STREET", 2, 120.0, 34.1, -118.3),
    ], INCIDENTS)
    st = spark.createDataFrame([(-118.25, 34.05, 1, "ALPHA", "a", 1), (-118.3, 34.1, 2, "BRAVO", "b", 2)], STATIONS)
    d1 = min(_hav(34.0, -118.0, 34.05, -118.25), _hav(34.0, -118.0, 34.1, -118.3))
    want = {2015: (round(d1, 6), 2), 2016: (0.0, 1)}
    for fn in (stations.nearest_by_year, stations.nearest_by_year_sql):
        got = {r.year: (r.mean_distance, r.crime_count) for r in fn(inc, st).collect()}
        assert got == want, fn.__name__
