"""Nearest-site operator against brute force (every point x every site)."""

from __future__ import annotations

import math
import random

import pytest

from blotter.operators.nearest import nearest_site, nearest_sites

from .conftest import plan_text


def _hav(lat1, lon1, lat2, lon2):
    p1, p2, l1, l2 = map(math.radians, (lat1, lat2, lon1, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * math.asin(min(1.0, math.sqrt(a))) * 6371.0


def _brute(points, sites):
    out = {}
    usable = [s for s in sites if s[1] is not None and s[2] is not None]
    for pid, lat, lon in points:
        if lat is None or lon is None or not usable:
            out[pid] = (None, None)
            continue
        best = min(((_hav(lat, lon, s[1], s[2]), s[0]) for s in usable))
        out[pid] = (best[1], best[0])
    return out


def _run(spark, points, sites, **kw):
    pdf = spark.createDataFrame(points, "pid bigint, LAT double, LON double")
    sdf = spark.createDataFrame(sites, "DIVISION string, Y double, X double")
    res = nearest_site(pdf, sdf, site_cols=["DIVISION"], **kw)
    return {r.pid: (r.DIVISION, r.distance) for r in res.collect()}, res


def _check(got, want):
    assert got.keys() == want.keys()
    for k, (div, d) in want.items():
        gdiv, gd = got[k]
        if d is None:
            assert gdiv is None and gd is None, k
            continue
        # exact same site unless two sites are equally near within rounding
        assert gd == pytest.approx(d, rel=1e-9, abs=1e-9), k
        assert gdiv == div or abs(gd - d) < 1e-9, (k, gdiv, div)


@pytest.mark.parametrize("seed,region", [(1, "city"), (2, "globe"), (3, "poles"), (4, "antimeridian")])
def test_nearest_matches_brute_force(spark, seed, region):
    rnd = random.Random(seed)

    def coord():
        if region == "city":
            return rnd.uniform(33.7, 34.3), rnd.uniform(-118.7, -118.1)
        if region == "globe":
            return rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        if region == "poles":
            return rnd.choice([-1, 1]) * rnd.uniform(80, 90), rnd.uniform(-180, 180)
        return rnd.uniform(-60, 60), rnd.choice([rnd.uniform(170, 180), rnd.uniform(-180, -170)])

    sites = [(f"S{i:03d}", *coord()) for i in range(40)]
    sites += [("T000", sites[0][1], sites[0][2]), ("A999", sites[1][1], sites[1][2])]  # exact ties
    sites += [("NULLSITE", None, None)]
    points = [(i, *coord()) for i in range(600)] + [(10_000, None, None), (10_001, None, 5.0)]
    points += [(20_000 + i, s[1], s[2]) for i, s in enumerate(sites[:5])]  # zero distance
    got, res = _run(spark, points, sites)
    _check(got, _brute(points, sites))
    plan = plan_text(res)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("cell_deg", [0.01, 1.0, 45.0])
def test_nearest_any_cell_size(spark, cell_deg):
    rnd = random.Random(7)
    sites = [(f"S{i}", rnd.uniform(30, 40), rnd.uniform(-120, -110)) for i in range(15)]
    points = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(200)]
    got, _ = _run(spark, points, sites, cell_deg=cell_deg)
    _check(got, _brute(points, sites))


def test_single_site_and_far_points(spark):
    sites = [("ONLY", 34.05, -118.25)]
    points = [(1, 34.05, -118.25), (2, -34.0, 61.75), (3, 0.0, 0.0), (4, 89.9, 100.0)]
    got, _ = _run(spark, points, sites)
    _check(got, _brute(points, sites))


def test_no_usable_sites(spark):
    got, res = _run(spark, [(1, 1.0, 2.0)], [("X", None, None)])
    assert got == {1: (None, None)}
    assert res.schema["distance"].dataType.simpleString() == "double"


def test_tie_goes_to_smallest_name(spark):
    sites = [("CHARLIE", 34.10, -118.30), ("BRAVO", 34.10, -118.30), ("ALPHA", 34.05, -118.25)]
    got, _ = _run(spark, [(1, 34.10, -118.30), (2, 34.11, -118.31)], sites)
    assert got[1][0] == "BRAVO" and got[2][0] == "BRAVO"


def test_many_sites_at_one_location_keep_candidates_small(spark):
    from pyspark.sql import functions as F

    from blotter.operators.nearest import SiteGrid

    sites = [(f"D{i:04d}", 34.05, -118.25) for i in range(500)] + [("ZZZ", 34.10, -118.30)]
    sdf = spark.createDataFrame(sites, "DIVISION string, Y double, X double")
    grid = SiteGrid.build(sdf, "Y", "X", ["DIVISION"])
    assert grid.site_count == 2
    pts = spark.createDataFrame([(1, 34.06, -118.26), (2, 34.2, -118.4)], "pid bigint, LAT double, LON double")
    cands, _ = grid.candidate_table(pts, "LAT", "LON")
    assert cands.select(F.max(F.size("__cands"))).first()[0] <= 2
    got, _ = _run(spark, [(1, 34.06, -118.26), (2, 34.2, -118.4)], sites)
    _check(got, _brute([(1, 34.06, -118.26), (2, 34.2, -118.4)], sites))
    assert got[1][0] == "D0000"


# --- k nearest ---------------------------------------------------------------------------

def _brute_k(points, sites, k):
    usable = [s for s in sites if s[1] is not None and s[2] is not None]
    return {pid: None if lat is None or lon is None else sorted((_hav(lat, lon, s[1], s[2]), s[0]) for s in usable)[:k]
            for pid, lat, lon in points}


def _run_k(spark, points, sites, k, **kw):
    pdf = spark.createDataFrame(points, "pid bigint, LAT double, LON double")
    sdf = spark.createDataFrame(sites, "DIVISION string, Y double, X double")
    res = nearest_sites(pdf, sdf, k, **kw)
    return {r.pid: None if r.nearest is None else [(n.distance, n.DIVISION) for n in r.nearest] for r in res.collect()}


def _check_k(got, want):
    assert got.keys() == want.keys()
    for pid, own in want.items():
        if own is None:
            assert got[pid] is None
            continue
        assert [d for d, _ in got[pid]] == pytest.approx([d for d, _ in own], rel=1e-9, abs=1e-9), pid
        distances = [d for d, _ in own]
        for (d, name), (_, told) in zip(own, got[pid]):
            assert name == told or sum(abs(d - e) < 1e-9 for e in distances) > 1 or abs(d - distances[-1]) < 1e-9, pid


@pytest.mark.parametrize("k,region", [(3, "city"), (3, "globe"), (5, "poles"), (2, "antimeridian"), (60, "globe")])
def test_k_nearest_match_brute_force(spark, k, region):
    rnd = random.Random(k)
    coord = {
        "city": lambda: (rnd.uniform(33.7, 34.3), rnd.uniform(-118.7, -118.1)),
        "globe": lambda: (rnd.uniform(-90, 90), rnd.uniform(-180, 180)),
        "poles": lambda: (rnd.choice([-1, 1]) * rnd.uniform(80, 90), rnd.uniform(-180, 180)),
        "antimeridian": lambda: (rnd.uniform(-60, 60), rnd.choice([rnd.uniform(170, 180), rnd.uniform(-180, -170)])),
    }[region]
    sites = [(f"S{i:03d}", *coord()) for i in range(40)] + [("NULLSITE", None, None)]
    sites += [(f"T{i:03d}", sites[0][1], sites[0][2]) for i in range(7)]  # several at one location
    points = [(i, *coord()) for i in range(300)] + [(1000, None, 1.0), (1001, sites[0][1], sites[0][2])]
    _check_k(_run_k(spark, points, sites, k), _brute_k(points, sites, k))


def test_k_nearest_ties_few_sites_and_none(spark):
    sites = [("CHARLIE", 34.10, -118.30), ("BRAVO", 34.10, -118.30), ("ALPHA", 34.05, -118.25)]
    got = _run_k(spark, [(1, 34.10, -118.30), (2, None, None)], sites, 5)
    assert [n for _, n in got[1]] == ["BRAVO", "CHARLIE", "ALPHA"] and got[2] is None
    assert _run_k(spark, [(1, 34.1, -118.3), (2, None, None)], [("X", None, None)], 2) == {1: [], 2: None}
    one = _run_k(spark, [(1, 34.2, -118.3)], sites, 1)
    single, _ = _run(spark, [(1, 34.2, -118.3)], sites)
    assert one[1][0][1] == single[1][0]
    with pytest.raises(ValueError):
        _run_k(spark, [(1, 0.0, 0.0)], sites, 0)


def test_k_nearest_far_cells_climb_the_levels(spark):
    rnd = random.Random(11)
    sites = [(f"S{i:03d}", rnd.uniform(34.0, 34.1), rnd.uniform(-118.1, -118.0)) for i in range(30)]
    points = [(i, rnd.uniform(-85, 85), rnd.uniform(-180, 180)) for i in range(150)]
    _check_k(_run_k(spark, points, sites, 4, cell_deg=0.01), _brute_k(points, sites, 4))


# --- the site index ----------------------------------------------------------------------

def _spread(seed, n):
    rnd = random.Random(seed)
    return rnd, [(f"S{i:03d}", rnd.uniform(33.7, 34.3), rnd.uniform(-118.7, -118.1)) for i in range(n)]


def test_second_query_builds_nothing(spark, tmp_path, monkeypatch):
    from blotter.operators import nearest

    rnd, sites = _spread(21, 25)
    points = [(i, rnd.uniform(33.7, 34.3), rnd.uniform(-118.7, -118.1)) for i in range(200)]
    first, _ = _run(spark, points, sites, index_folder=str(tmp_path))
    _check(first, _brute(points, sites))

    def built(*a, **k):
        raise AssertionError("the index was not used")

    for name in ("candidate_cells", "_choose_exponent"):
        monkeypatch.setattr(nearest, name, built)
    again, _ = _run(spark, points[:150], list(reversed(sites)), index_folder=str(tmp_path))
    assert again == {p: first[p] for p in again} and len(again) == 150


def test_index_grows_by_missing_cells_only(spark, tmp_path, monkeypatch):
    from blotter.operators import nearest

    rnd, sites = _spread(22, 25)
    near = [(i, rnd.uniform(33.7, 34.0), rnd.uniform(-118.7, -118.4)) for i in range(100)]
    more = near + [(i, rnd.uniform(33.7, 34.3), rnd.uniform(-118.7, -118.1)) for i in range(100, 250)]
    _run(spark, near, sites, index_folder=str(tmp_path))
    built, real = [], nearest.candidate_cells

    def counted(cells, *a, **k):
        built.append(cells.count())
        return real(cells, *a, **k)

    monkeypatch.setattr(nearest, "candidate_cells", counted)
    got, _ = _run(spark, more, sites, index_folder=str(tmp_path))
    _check(got, _brute(more, sites))
    cells = nearest.SiteGrid.build(spark.createDataFrame(sites, "DIVISION string, Y double, X double"), "Y", "X", ["DIVISION"],
                                   index_folder=str(tmp_path))
    held, _ = cells.index.cells()
    assert len(cells.index.parts) == 2 and len(built) == 1 and 0 < built[0] < held.count()
    assert held.count() == held.select("__x0", "__y0").distinct().count()


def test_index_of_other_sites_is_not_used(spark, tmp_path):
    rnd, sites = _spread(23, 20)
    points = [(i, rnd.uniform(33.7, 34.3), rnd.uniform(-118.7, -118.1)) for i in range(100)]
    for own in (sites, sites[:-1], [(n, y, x + 0.1) for n, y, x in sites], [("Z" + n, y, x) for n, y, x in sites]):
        got, _ = _run(spark, points, own, index_folder=str(tmp_path))
        _check(got, _brute(points, own))
    assert len(list((tmp_path / "site-index").iterdir())) == 4


def test_unfinished_parts_are_not_read(spark, tmp_path):
    from blotter.operators.siteindex import SiteIndex

    index = SiteIndex.at(spark, "f" * 32, str(tmp_path))
    assert index.cells() == (None, 0) and index.exponent is None
    cells = spark.createDataFrame([(1, 2, [(0.0, 0.0, "A")])], "__x0 long, __y0 long, __cands array<struct<__slat:double,__slon:double,DIVISION:string>>")
    cells.write.parquet(f"{index.folder}/cells/lost")  # written, but its job ended before the manifest
    assert SiteIndex.at(spark, "f" * 32, str(tmp_path)).cells() == (None, 0)
    index.add(cells, 100, 9)
    index.add(cells, 100, 9)  # the same cells by another application
    held, size = SiteIndex.at(spark, "f" * 32, str(tmp_path)).cells()
    assert held.count() == 1 and size == 200


def test_no_window_over_sites(spark, tmp_path, monkeypatch):
    """The plans that build candidates for one nearest site hold no window; those for k rank with a limit before the shuffle."""
    from blotter.operators import nearest

    plans, real = [], nearest.materialize_counted
    monkeypatch.setattr(nearest, "materialize_counted", lambda df, **m: plans.append(plan_text(df)) or real(df, **m))
    rnd, sites = _spread(24, 20)
    points = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(80)]
    _run(spark, points, sites, index_folder=str(tmp_path), cell_deg=0.01)
    assert plans and not any("Window" in p for p in plans)
    plans.clear()
    _run_k(spark, points, sites, 3, index_folder=str(tmp_path), cell_deg=0.01)
    ranked = [p for p in plans if "Window [" in p]
    assert ranked and all("WindowGroupLimit" in p for p in ranked)
