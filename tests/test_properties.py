"""Property tests: each property draws a batch of examples and checks them in one Spark job."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.functions.rowwise import part_of_day_py
from blotter.functions.scalars import format_money, haversine_km, parse_money, part_of_day
from blotter.operators.nearest import nearest_site
from blotter.operators.rank import top_k_per_group
from blotter.sources.periods import union_periods

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

lat = st.floats(min_value=-90, max_value=90, allow_nan=False)
lon = st.floats(min_value=-180, max_value=180, allow_nan=False)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-100, max_value=3000)), min_size=1, max_size=60))
def test_part_of_day_column_equals_python_twin(spark, clocks):
    df = spark.createDataFrame([(c,) for c in clocks], "c int")
    got = [r.p for r in df.select(part_of_day("c").alias("p")).collect()]
    assert got == [part_of_day_py(c) for c in clocks]


@SETTINGS
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=40))
def test_money_text_roundtrip(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "a bigint")
    got = [r.b for r in df.select(parse_money(format_money("a"), "bigint").alias("b")).collect()]
    assert got == amounts


@SETTINGS
@given(st.lists(st.tuples(lat, lon, lat, lon, lat, lon), min_size=1, max_size=40))
def test_haversine_metric_properties(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double")
    out = df.select(haversine_km("a", "b", "c", "d").alias("ab"), haversine_km("c", "d", "a", "b").alias("ba"),
                    haversine_km("c", "d", "e", "f").alias("bc"), haversine_km("a", "b", "e", "f").alias("ac"),
                    haversine_km("a", "b", "a", "b").alias("aa")).collect()
    for r in out:
        assert math.isclose(r.ab, r.ba, rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.ab <= math.pi * 6371.0 + 1e-6
        assert r.aa == 0.0
        assert r.ac <= r.ab + r.bc + 1e-6  # triangle inequality


@SETTINGS
@given(st.lists(st.tuples(lat, lon), min_size=1, max_size=12),
       st.lists(st.tuples(lat, lon), min_size=1, max_size=40))
def test_nearest_is_never_beaten(spark, sites, points):
    sdf = spark.createDataFrame([(f"S{i:02d}", a, b) for i, (a, b) in enumerate(sites)], "DIVISION string, "
                                                                                         "Y double, X double")
    pdf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)], "pid bigint, LAT double, LON double")
    near = nearest_site(pdf, sdf, site_cols=["DIVISION"])
    # every site is at least as far as the chosen one (checked by Spark over the small fixture)
    check = (near.join(sdf.withColumnRenamed("DIVISION", "other"))
             .filter(haversine_km("LAT", "LON", "Y", "X") < F.col("distance") - 1e-9))
    assert check.count() == 0
    assert near.filter(F.col("DIVISION").isNull()).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=50))
def test_union_periods_idempotent_and_distinct(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    once = union_periods([df, df])
    assert sorted(once.collect()) == sorted(set(df.collect()))
    assert union_periods([once, once]).count() == once.count()


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 20)), min_size=1, max_size=50),
       st.integers(min_value=1, max_value=4))
def test_top_k_per_group_bounds(spark, rows, k):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g int, v int, i int")
    out = top_k_per_group(df, ["g"], [F.desc("v"), F.asc("i")], k).collect()
    for g in {r[0] for r in rows}:
        members = sorted(((v, -i) for i, (gg, v) in enumerate(rows) if gg == g), reverse=True)[:k]
        got = sorted(((r.v, -r.i) for r in out if r.g == g), reverse=True)
        assert got == members
