from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from blotter.functions.rowwise import part_of_day_py
from blotter.functions.scalars import (DESCENT_LABELS, code_label, format_money, haversine_km, hhmm,
                                       parse_money, part_of_day)
from blotter.functions.sql import register_sql_functions

EDGES = {
    0: "Night", 359: "Night", 400: None, 459: None, 499: None, 500: "Morning", 1159: "Morning",
    1200: "Afternoon", 1659: "Afternoon", 1700: "Evening", 2059: "Evening", 2100: "Night", 2359: "Night",
}


def test_part_of_day_edges(spark):
    rows = [(k,) for k in EDGES] + [(None,)]
    df = spark.createDataFrame(rows, "clock int")
    got = {r.clock: r.p for r in df.select("clock", part_of_day("clock").alias("p")).collect()}
    assert got == {**EDGES, None: None}


def test_part_of_day_python_twin_matches_every_clock(spark):
    df = spark.range(0, 2400).select(F.col("id").cast("int").alias("clock"))
    got = {r.clock: r.p for r in df.select("clock", part_of_day("clock").alias("p")).collect()}
    assert all(part_of_day_py(c) == p for c, p in got.items())
    assert part_of_day_py(None) is None


def test_part_of_day_sql_function(spark):
    register_sql_functions(spark)
    got = {r.c: r.p for r in spark.sql(
        "SELECT c, blotter_part_of_day(c) AS p FROM VALUES (359), (400), (500), (2100), (NULL) AS t(c)").collect()}
    assert got == {359: "Night", 400: None, 500: "Morning", 2100: "Night", None: None}


def test_hhmm(spark):
    df = spark.createDataFrame([("2024-01-01 13:05:09",), ("2024-01-01 00:00:00",), (None,)], "t string")
    got = [r.h for r in df.select(hhmm(F.col("t").cast("timestamp")).alias("h")).collect()]
    assert got == [1305, 0, None]


@pytest.mark.parametrize("text,value", [
    ("$12,000", 12000), ("$102,406", 102406), ("$5", 5), ("n/a", None), (None, None), ("$-821", -821), ("", None),
])
def test_parse_money(spark, text, value):
    df = spark.createDataFrame([(text,)], "m string")
    assert df.select(parse_money("m").alias("v")).first().v == value


def test_format_money_roundtrip(spark):
    df = spark.createDataFrame([(12000,), (-821,), (0,), (1234567,)], "v bigint")
    out = df.select(format_money("v").alias("t"), parse_money(format_money("v")).alias("back")).collect()
    assert [r.t for r in out] == ["$12,000", "$-821", "$0", "$1,234,567"]
    assert [r.back for r in out] == [12000, -821, 0, 1234567]


def test_code_label(spark):
    df = spark.createDataFrame([("H",), ("W",), ("Q",), (None,)], "c string")
    got = [r.l for r in df.select(code_label("c").alias("l")).collect()]
    assert got == [DESCENT_LABELS["H"], DESCENT_LABELS["W"], "Q", None]
    assert len(DESCENT_LABELS) == 19


def _hav(lat1, lon1, lat2, lon2):
    p1, p2, l1, l2 = map(math.radians, (lat1, lat2, lon1, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * math.asin(min(1.0, math.sqrt(a))) * 6371.0


def test_haversine_properties(spark):
    pts = [(34.05, -118.25, 34.10, -118.30), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0),
           (34.05, -118.25, 34.05, -118.25), (-33.9, 151.2, 51.5, -0.12), (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    out = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y")).collect()
    for (a, b, c, d), r in zip(pts, out):
        if a is None:
            assert r.x is None and r.y is None
            continue
        assert r.x == pytest.approx(_hav(a, b, c, d), rel=1e-12, abs=1e-9)
        assert r.x == pytest.approx(r.y, rel=1e-12, abs=1e-9)
        assert 0 <= r.x <= math.pi * 6371.0 + 1e-6
    assert out[3].x == 0.0


def test_haversine_sql_matches_column_expression(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(34.05, -118.25, 34.10, -118.30), (1.0, 2.0, 3.0, 4.0)], "a double, b double, "
                                                                                          "c double, d double")
    df.createOrReplaceTempView("hav_points")
    sql = spark.sql("SELECT blotter_haversine_km(a, b, c, d) AS x FROM hav_points").collect()
    col = df.select(haversine_km("a", "b", "c", "d").alias("x")).collect()
    assert [r.x for r in sql] == [r.x for r in col]
