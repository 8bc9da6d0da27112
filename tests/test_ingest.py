from __future__ import annotations

import datetime as dt
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter import schemas
from blotter.plans import descent, months, part_of_day, stations
from blotter.sources.csv import (csv_text_roundtrip, read_csv_strings, read_incidents, read_income, read_revgeo,
                                 read_stations)
from blotter.sources.periods import tag_and_union, union_all, union_periods

from .conftest import formatted_plan
from .fixtures import write_dimensions, write_incident_periods


@pytest.fixture(scope="module")
def files():
    folder = Path(tempfile.mkdtemp(prefix="blotter-fixtures-", dir="/tmp"))
    a, b = write_incident_periods(folder)
    return {"a": a, "b": b, **write_dimensions(folder)}


@pytest.fixture(scope="module")
def incidents(spark, files):
    return union_periods([read_incidents(spark, files["a"]), read_incidents(spark, files["b"])])


def test_header_names_bind_by_name_and_are_trimmed(spark, files):
    raw = read_csv_strings(spark, files["a"])
    assert "AREA" in raw.columns and "AREA " not in raw.columns
    assert all(isinstance(f.dataType, T.StringType) for f in raw.schema)
    assert raw.count() == 4  # header line is not a data row


def test_typed_schema_and_tolerant_casts(spark, files):
    df = read_incidents(spark, files["b"])
    assert [f.name for f in df.schema] == [f.name for f in schemas.INCIDENT]
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.INCIDENT]
    bad = df.filter(F.col("DR_NO") == 5).first()
    assert bad["Date Rptd"] is None and bad["TIME OCC"] is None and bad["Weapon Used Cd"] is None
    assert bad["LAT"] is None and bad["DATE OCC"] == dt.datetime(2016, 3, 1)


def test_twelve_hour_timestamps(spark, files):
    df = read_incidents(spark, files["a"])
    got = {r.DR_NO: r["DATE OCC"] for r in df.collect()}
    assert got[2] == dt.datetime(2015, 2, 20, 13, 5, 9)
    assert got[1] == dt.datetime(2015, 2, 19, 0, 0, 0)


def test_union_periods_removes_cross_file_duplicate(spark, files, incidents):
    a, b = read_incidents(spark, files["a"]), read_incidents(spark, files["b"])
    assert union_all([a, b]).count() == 7
    assert incidents.count() == 6
    assert sorted(r.DR_NO for r in incidents.collect()) == [1, 2, 3, 4, 5, 6]


def test_union_periods_idempotent(incidents):
    assert union_periods([incidents, incidents]).count() == incidents.count()


def test_tag_and_union_literal(spark, files):
    a, b = read_incidents(spark, files["a"]), read_incidents(spark, files["b"])
    counts = {r.period: r["count"] for r in tag_and_union([("x", a), ("y", b)]).groupBy("period").count().collect()}
    assert counts == {"x": 4, "y": 3}


def test_income_money_and_quoted_comma(spark, files):
    inc = read_income(spark, files["income"])
    rows = {r["Community"]: (r["Zip Code"], r["Estimated Median Income"]) for r in inc.collect()}
    assert rows["Sample, with comma"] == (90005, 55250)
    assert rows["Sample I"] == (None, None)
    assert rows["Sample H"] == (91046, 5)


def test_dimension_types(spark, files):
    rv = read_revgeo(spark, files["revgeo"])
    st = read_stations(spark, files["stations"])
    assert rv.schema == schemas.REVGEO and st.schema == schemas.STATION
    assert st.filter(F.col("X").isNull()).count() == 1


def test_headerless_positional_read(spark, tmp_path):
    p = tmp_path / "nohdr.csv"
    p.write_text("34.05,-118.25,90001\n34.10,-118.30,90003\n")
    rv = read_revgeo(spark, str(p), header=False)
    assert rv.count() == 2 and rv.first()["ZIPcode"] == 90001


def test_csv_text_roundtrip_keeps_values(spark):
    df = spark.createDataFrame([(1, 1.25, "a,b", None), (2, 1e-7, 'q"x', 3.5)],
                               "k bigint, v double, s string, f double")
    back = csv_text_roundtrip(df)
    assert back.schema == df.schema
    assert sorted(back.collect()) == sorted(df.collect())


def test_part_of_day_on_fixtures(incidents):
    got = {r.part_of_day: r.crime_count for r in part_of_day.street_by_part_of_day(incidents).collect()}
    assert got == {"Night": 2, None: 2, "Morning": 1}
    sql = {r.part_of_day: r.crime_count for r in part_of_day.street_by_part_of_day_sql(incidents).collect()}
    rdd = {r.part_of_day: r.crime_count for r in part_of_day.street_by_part_of_day_rdd(incidents).collect()}
    assert sql == got == rdd


def test_top_months_on_fixtures(incidents):
    got = [tuple(r) for r in months.top_months_per_year(incidents).collect()]
    assert got == [(2015, 2, 2, 1), (2016, 3, 3, 1)]
    assert [tuple(r) for r in months.top_months_per_year_sql(incidents).collect()] == got


def test_descent_on_fixtures(spark, files, incidents):
    income = read_income(spark, files["income"])
    revgeo = read_revgeo(spark, files["revgeo"])
    for strategy in ("auto", "broadcast", "merge", "shuffle_hash"):
        got = {r.descent: r.victim_count for r in descent.dim_restricted_counts(
            incidents, revgeo, income, year=2015, exclude_zips=(91046, 91210), strategy=strategy).collect()}
        assert got == {"Hispanic/Latin/Mexican": 1, "White": 1, "Q": 1}, strategy


def test_income_extremes_ties_by_zip(spark, files):
    ext = descent.income_extremes(read_income(spark, files["income"]), 3, (91046, 91210))
    assert sorted(r["Zip Code"] for r in ext.collect()) == [90001, 90002, 90003, 90005, 90006, 90007]


def test_stations_on_fixtures(spark, files, incidents):
    st = read_stations(spark, files["stations"])
    by_div = {r.division: r.crime_count for r in stations.responsible_by_division(incidents, st).collect()}
    # weapon not NULL: rows 1, 2, 4, 6; AREA 99 has no station
    assert by_div == {"ALPHA": 3}
    near = {r.division: r.crime_count for r in stations.nearest_by_division(incidents, st).collect()}
    near_sql = {r.division: r.crime_count for r in stations.nearest_by_division_sql(incidents, st).collect()}
    assert near == near_sql
    assert sum(near.values()) == 4 and "DELTA" not in near and "CHARLIE" not in near


def test_narrow_read_by_name(spark, files):
    cols = ["DR_NO", "Date Rptd", "DATE OCC", "AREA", "LAT"]
    df = read_incidents(spark, files["a"], columns=cols)
    assert df.columns == cols
    row = df.filter(F.col("DR_NO") == 1).first()
    assert row["AREA"] == 1 and row["LAT"] == 34.05


def test_checkpoint_dir_required_off_local(spark, monkeypatch):
    from blotter import session

    class FakeSc:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class FakeConf:
        def get(self, key, default=None):
            return default

    class FakeSpark:
        sparkContext = FakeSc()
        conf = FakeConf()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(FakeSpark())


def test_command_line_questions(spark, files, tmp_path):
    from blotter.__main__ import main

    inc = ["--incidents", files["a"], files["b"]]
    out = main(["top-months", *inc, "--out", str(tmp_path / "months")], spark)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "months")).orderBy("year", "rank").collect()] == \
        [(2015, 2, 2, 1), (2016, 3, 3, 1)]
    assert out.columns == ["year", "month", "crime_total", "rank"]
    got = {r.descent: r.victim_count for r in main(
        ["descent", *inc, "--income", files["income"], "--revgeo", files["revgeo"], "--strategy", "merge"],
        spark).collect()}
    assert got == {"Hispanic/Latin/Mexican": 1, "White": 1, "Q": 1}
    near = main(["nearest", *inc, "--stations", files["stations"], "--by", "division", "--api", "sql"], spark)
    assert sum(r.crime_count for r in near.collect()) == 4
    pod = {r.part_of_day: r.crime_count for r in main(["part-of-day", *inc, "--api", "rdd"], spark).collect()}
    assert pod == {"Night": 2, None: 2, "Morning": 1}
    assert {r.table: r.row_count for r in main(["profile", *inc], spark).collect()}["incidents"] == 6


def test_command_line_remaining_questions(spark, files):
    from blotter.__main__ import main

    inc = ["--incidents", files["a"], files["b"]]
    by_year = main(["responsible", *inc, "--stations", files["stations"], "--by", "year", "--strategy", "merge"],
                   spark)
    by_year_sql = main(["responsible", *inc, "--stations", files["stations"], "--by", "year", "--api", "sql"], spark)
    assert sorted(by_year.collect()) == sorted(by_year_sql.collect())
    near = main(["nearest", *inc, "--stations", files["stations"], "--by", "year"], spark)
    assert sum(r.crime_count for r in near.collect()) == 3  # firearm rows 1, 4 and 6
    schema = main(["schema", *inc], spark)
    assert schema.count() == 28


# --- files with headers of their own -----------------------------------------------------

def _rows_by_name(df):
    return sorted(tuple((c, r[c]) for c in sorted(df.columns)) for r in df.collect())


def test_files_of_different_column_order(spark, tmp_path):
    """Each file binds by its own header: a list of paths equals the union of single reads."""
    (tmp_path / "a.csv").write_text("Zip Code,Community,Estimated Median Income\n1,A,$10\n")
    (tmp_path / "b.csv").write_text("Estimated Median Income,Community,Zip Code\n\"$1,020\",\"B, b\",2\n")
    (tmp_path / "c.csv").write_text("Community , Zip Code,Estimated Median Income\nC,3,$30\n")
    paths = [str(tmp_path / f"{n}.csv") for n in "abc"]
    got = read_income(spark, paths)
    assert sorted(map(tuple, got.collect())) == [(1, "A", 10), (2, "B, b", 1020), (3, "C", 30)]
    assert _rows_by_name(got) == _rows_by_name(union_all([read_income(spark, p) for p in paths]))
    assert _rows_by_name(read_income(spark, str(tmp_path))) == _rows_by_name(got)  # a folder
    assert _rows_by_name(read_income(spark, f"{tmp_path}/*.csv")) == _rows_by_name(got)  # a glob


def test_files_of_one_header_are_one_scan(spark, files, tmp_path):
    for n in "abcd":
        (tmp_path / f"{n}.csv").write_text("x,y\n1,2\n" if n < "c" else "y,x\n2,1\n")
    df = read_csv_strings(spark, str(tmp_path))
    assert [tuple(r) for r in df.collect()] == [("1", "2")] * 4
    assert formatted_plan(df).count("Scan csv") == 4  # two scans, each in the tree and in its details
    assert formatted_plan(read_csv_strings(spark, files["a"])).count("Scan csv") == 2


def test_headers_of_odd_files(spark, tmp_path):
    import gzip

    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header_only.csv").write_text("x,y\n")
    (tmp_path / "blank_first.csv").write_text("\n\ny,x\n1,2\n")
    (tmp_path / "with, comma [1].csv").write_text("y,x\n3,4\n")
    (tmp_path / "crlf.csv").write_bytes(b"x,y\r\n5,6\r\n")
    (tmp_path / "percent %20.csv").write_text("X,Y\n7,8\n")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write("y,x\n9,0\n")
    got = {(r["x"], r["y"]) for r in read_csv_strings(spark, str(tmp_path)).collect()}
    assert got == {("2", "1"), ("4", "3"), ("5", "6"), ("7", "8"), ("0", "9")}


def test_only_empty_files(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.csv").write_text("")
    assert read_csv_strings(spark, str(tmp_path)).count() == 0


def test_columns_that_some_files_lack(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y\n3\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv_strings(spark, str(tmp_path))
    got = read_csv_strings(spark, str(tmp_path), missing="null")
    assert sorted(((r.x, r.y) for r in got.collect()), key=str) == [("1", "2"), (None, "3")]
    with pytest.raises(ValueError):
        read_csv_strings(spark, str(tmp_path), missing="drop")


def test_many_files_probe_in_bounded_jobs(spark, tmp_path, monkeypatch):
    from blotter.sources import headers

    monkeypatch.setattr(headers, "FILES_PER_JOB", 3)
    for i in range(10):
        (tmp_path / f"{i}.csv").write_text(f"x,y\n{i},0\n" if i % 2 else f"y,x\n0,{i}\n")
    got = read_csv_strings(spark, str(tmp_path))
    assert sorted((int(r.x), r.y) for r in got.collect()) == [(i, "0") for i in range(10)]


def test_period_files_in_one_call(spark, files):
    """The two period files of the reference in one call."""
    both = read_incidents(spark, [files["a"], files["b"]])
    one_by_one = union_all([read_incidents(spark, files["a"]), read_incidents(spark, files["b"])])
    assert sorted(map(str, both.collect())) == sorted(map(str, one_by_one.collect()))
    assert both.filter("AREA IS NULL").count() == 0


def test_rejected_fields_and_broken_lines(spark, files, tmp_path):
    from blotter.sources.csv import read_incidents_with_rejects, typed_with_rejects

    got = {r.DR_NO: r for r in read_incidents_with_rejects(spark, [files["a"], files["b"]]).collect()}
    assert got[5].rejected_fields == ["Date Rptd", "TIME OCC", "Weapon Used Cd"]
    assert got[1].rejected_fields == [] and all(r._corrupt_record is None for r in got.values())
    assert got[5]["DATE OCC"] == dt.datetime(2016, 3, 1)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.DoubleType()), T.StructField("s", T.StringType())])
    (tmp_path / "bad.csv").write_text("k,v,s\n1,1.5,a\n2,x,b\n3\n4,4.5,d,more\n5,  ,\n,,\n")
    raw = read_csv_strings(spark, str(tmp_path / "bad.csv"), corrupt_column="_corrupt_record")
    out = typed_with_rejects(raw, schema)
    rows = {r.k: (r.v, r.s, r.rejected_fields, r._corrupt_record) for r in out.collect() if r.k is not None}
    assert rows == {1: (1.5, "a", [], None), 2: (None, "b", ["v"], None), 3: (None, None, [], "3"),
                    4: (4.5, "d", [], "4,4.5,d,more"), 5: (None, None, [], None)}
    # The account is the same when only some columns are asked for.
    assert sorted(r[0] for r in out.filter("_corrupt_record IS NOT NULL").select("k").collect()) == [3, 4]
    assert [r[0] for r in out.filter("size(rejected_fields) > 0").select("k").collect()] == [2]
    with pytest.raises(ValueError):
        typed_with_rejects(raw, schema, rejects="k")
    assert typed_with_rejects(raw.filter(F.lit(False)), schema).count() == 0


def test_command_line_newer_routes(spark, files):
    from blotter.__main__ import main

    inc = ["--incidents", files["a"], files["b"]]
    assert [r.DR_NO for r in main(["rejects", *inc], spark).collect()] == [5]
    pod = {r.part_of_day: r.crime_count for r in main(["part-of-day", *inc, "--api", "arrow"], spark).collect()}
    assert pod == {"Night": 2, None: 2, "Morning": 1}
    near = main(["nearest", *inc, "--stations", files["stations"], "--by", "rank", "--k", "2"], spark).collect()
    assert sorted({r["rank"] for r in near}) == [1, 2] and sum(r.crime_count for r in near) == 8
    dims = ["--income", files["income"], "--revgeo", files["revgeo"]]
    got = {r.descent: r.victim_count for r in main(["descent", *inc, *dims, "--strategy", "bloom"], spark).collect()}
    assert got == {"Hispanic/Latin/Mexican": 1, "White": 1, "Q": 1}
    by = [main(["responsible", *inc, "--stations", files["stations"], "--strategy", x], spark).collect() for x in ("salted", "merge")]
    assert by[0] == by[1]
