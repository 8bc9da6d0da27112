"""Registered queries vs their DuckDB oracle on the smallest generated tables, plus plan checks."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from blotter.operators import filters
from blotter.plans import catalog, descent, ingest, months
from blotter.plans.catalog import QUERIES
from blotter.plans.oracle import ORACLE_SQL
from blotter.sources import tables as tb

from .conftest import SF_SMALL, formatted_plan, plan_text

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(SF_SMALL) / (t + '.parquet')}')")
    return c


def _norm_rows(rows):
    def norm(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE_SQL


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    order = [cols.index(c) for c in sorted(cols)]
    oorder = [rel.columns.index(c) for c in sorted(rel.columns)]
    want = rel.fetchall()
    assert _norm_rows([tuple(r[i] for i in order) for r in got]) == \
        _norm_rows([tuple(r[i] for i in oorder) for r in want])


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["division", "mean_distance", "crime_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.endswith(("_rdd", "_arrow"))])
def test_no_python_in_dataframe_queries(spark, name):
    plan = plan_text(queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_enumeration(spark, name):
    plan = plan_text(queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scan(spark):
    plan = formatted_plan(queries()["street_by_part_of_day"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    plan = formatted_plan(queries()["dim_restricted_counts"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan


def test_rank_queries_prelimit_before_shuffle(spark):
    for name in ("top_months_per_year", "nearest_by_division"):
        assert "WindowGroupLimit" in plan_text(queries()[name](spark, SF_SMALL)), name


def _same(con, df, sql):
    rel = con.sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    want = [tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()]
    return _norm_rows(got) == _norm_rows(want)


@pytest.fixture(scope="module")
def inc(spark):
    return catalog._incidents(spark, SF_SMALL)


def test_oracles_notice_wrong_answers(spark, con, inc, monkeypatch):
    """Each mutation of the code turns its key red."""
    assert not _same(con, months.top_months_per_year(inc, 3, "DATE OCC"), ORACLE_SQL["top_months_per_year"])
    assert not _same(con, months.top_months_per_year(inc, 3, required=()), ORACLE_SQL["top_months_per_year"])
    li = tb.table(spark, SF_SMALL, "lineitem")
    facts = tb.coded_facts_from_lineitem(li)
    swapped = dict(descent.DESCENT_LABELS, A="Black", B="Other Asian")
    assert not _same(con, descent.code_label_counts(facts, swapped), ORACLE_SQL["code_label_counts"])
    assert not _same(con, facts.select("Vict Descent").na.drop().transform(descent.code_label_counts), ORACLE_SQL["code_label_counts"])
    without_lat = [df.drop("LAT").crossJoin(spark.range(1).selectExpr("0D AS LAT")) for df in (facts, tb.revgeo_from_lineitem(li))]
    counted = descent.dim_restricted_counts(*without_lat, catalog._income(spark, SF_SMALL), year=1998, exclude_zips=(3, 7))
    assert not _same(con, counted, ORACLE_SQL["dim_restricted_counts"])
    nan = catalog._incidents_with_nan(spark, SF_SMALL)
    monkeypatch.setattr(ingest, "drop_missing", lambda df, cols: filters.not_null(df, *cols))
    assert not _same(con, ingest.located_firearm_incidents(nan), ORACLE_SQL["filter_not_null_range"])
    monkeypatch.setattr(ingest, "drop_missing", lambda df, cols: df)
    assert not _same(con, ingest.located_firearm_incidents(nan), ORACLE_SQL["filter_not_null_range"])


def test_queries_leave_no_views_or_functions(spark):
    def held():
        views = {r["viewName"] for r in spark.sql("SHOW VIEWS").collect()}
        return views, {r["function"] for r in spark.sql("SHOW USER FUNCTIONS").collect()}

    from blotter.functions.sql import drop_sql_functions

    drop_sql_functions(spark)
    before = held()
    for name in sorted(QUERIES):
        if name.endswith("_sql") or name == "haversine_sql_function":
            QUERIES[name](spark, SF_SMALL).count()
    assert held() == before


JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("dim_restricted", "responsible", "haversine"))))
def test_plans_do_not_depend_on_size(spark, name):
    plans = [plan_text(QUERIES[name](spark, d)) for d in (SF_SMALL, SF_SMALL.replace("0.001", "0.01"))]
    assert len({tuple(p.count(j) for j in JOINS) for p in plans}) == 1


def test_profile_reads_each_period_once(spark):
    plan = plan_text(QUERIES["profile_count"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 2
    assert "Join" not in plan_text(QUERIES["filter_exclude_set"](spark, SF_SMALL))
