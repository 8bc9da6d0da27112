"""Nearest site for every point, exact, without a cross join.

The reference pairs every incident with every station and keeps the closest.
That is rows x sites distance evaluations. Here the work is split in two:

1. **Candidate cells (small side).** Points are bucketed on a lat/lon grid of
   cell size ``d0 = 360 / 2**k`` degrees, k chosen from how densely sites
   share cells. For each *occupied* cell (a distinct set bounded by the grid's
   area, not by the row count) we find the sites that could be nearest to
   *any* point of that cell, by looking in the 3x3 block of cells around it on
   a pyramid of grids (``d0, 2*d0, 4*d0 .. 180``):

   * every site within the block gets bounds ``lb <= dist(p, site) <= ub`` for
     all points p of the cell (cell centre distance -/+ a rigorous cell radius);
   * the block is *sufficient* when the best ``ub`` is below ``G``, a lower
     bound on the distance from the cell to anything outside the block; sites
     outside are then strictly farther than that candidate for every point;
   * candidates are the block sites with ``lb <= min ub``; an insufficient
     cell moves on to the next (coarser) level. The top level's block covers
     the whole globe, so every cell resolves and no site is ever capped away.

   Bounds come from a partial minimum per cell and level (for the k nearest,
   the k-th smallest from a rank that is limited before its shuffle), so the
   sites of a block are never gathered; only candidates that passed are.
   Levels run in batches, one job per batch, on cells still unresolved; past
   the first batch, nearby far-away cells are searched together as one coarser
   unit, so a cell far from every site costs one pairing per unit, not per cell.
   Each batch's output is checkpointed, so the loop's lineage stays short and
   survives executor loss. The finished cells go to a site index
   (``operators.siteindex``), which later queries on the same sites find.

2. **Points (big side).** One equi-join of points to their cell's candidate
   array (broadcast when the candidate table is proven small, else a sort-merge
   join where AQE's skew handling splits hot cells), then ``array_min`` over the few
   candidates' ``(distance, tie-break, ...)`` structs. Points are never
   shuffled by point key and never paired with sites outside their candidates.

``nearest_sites`` gives the k nearest as an array in order, by the same cells.

Ties in distance go to the smallest ``tie_break`` value. Points with NULL/NaN
or out-of-range coordinates, and all points when no site has coordinates, get
NULL site columns and NULL distance; they are kept (left join).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import EARTH_RADIUS_KM, haversine_km, is_valid_coordinate
from ..session import materialize, materialize_counted
from .joins import DEFAULT_MAX_BROADCAST_BYTES, row_bytes
from .siteindex import SiteIndex, fingerprint_metrics, fingerprint_of

# Slack (km) on every bound comparison; far above haversine rounding error.
_EPS_KM = 1e-7
_MIN_CELL_DEG = 1e-4
_MAX_EXPONENT = 22  # finest cell 360 / 2**22 degrees (about 10 m)
_SHARE_RATIO = 1.25
# Past the first batch of levels, the search unit at level l is the cell of level
# l - _UNIT_LAG holding the fine cell, so far-away cells collapse into few units.
_UNIT_LAG = 2


def _cell_index(lat: Column, lon: Column, level_deg: float) -> tuple[Column, Column]:
    nx = int(round(360.0 / level_deg))
    ny = max(1, nx // 2)
    x = F.pmod(F.floor((lon + F.lit(180.0)) / F.lit(level_deg)), F.lit(nx))
    y = F.floor((lat + F.lit(90.0)) / F.lit(level_deg))
    y = F.when(y < 0, F.lit(0)).when(y > ny - 1, F.lit(ny - 1)).otherwise(y)
    return x.cast("bigint"), y.cast("bigint")


def _choose_exponent(sites: DataFrame, lat: str, lon: str, cell_deg: float | None) -> tuple[int | None, int | None]:
    """Grid exponent k (cell = 360 / 2**k degrees) and the exact site count when it was counted.

    The exponent is None when there are no sites.

    By default the finest cells are about half the spacing of sites *where
    sites are*: one small aggregate counts (approximately) the distinct
    occupied cells at every resolution (a 21-row result), and the finest resolution where sites
    still share cells (``_SHARE_RATIO`` sites per occupied cell) sets the scale. Clustered sites thus
    get fine cells inside their clusters, which a bounding-box spacing would
    miss. Only speed depends on this choice, never the result.
    """
    if cell_deg is not None:
        if sites.isEmpty():
            return None, 0
        cell_deg = min(max(cell_deg, _MIN_CELL_DEG), 90.0)
        return max(2, math.ceil(math.log2(360.0 / cell_deg))), None
    ks = list(range(2, _MAX_EXPONENT + 1))
    # Finest cell once; coarser cells are its bit-shifted prefixes.
    fx, fy = _cell_index(F.col(lat), F.col(lon), 360.0 / (2 ** _MAX_EXPONENT))
    shift = F.explode(F.sequence(F.lit(0), F.lit(_MAX_EXPONENT - 2))).alias("s")
    occupied = (sites.select(fx.alias("fx"), fy.alias("fy")).select("fx", "fy", shift)
                .select((F.lit(_MAX_EXPONENT) - F.col("s")).alias("k"),
                        F.expr("shiftleft(shiftright(fx, s), 32) + shiftright(fy, s)").alias("c"))
                .groupBy("k").agg(F.approx_count_distinct("c", 0.02).alias("cells"),
                                  F.count(F.lit(1)).alias("n")))
    rows = occupied.collect()  # one row per resolution (21 rows)
    if not rows:
        return None, 0
    cells_at = {r["k"]: r["cells"] for r in rows}
    n = rows[0]["n"]
    shared = [k for k in ks if n >= _SHARE_RATIO * cells_at[k]]
    return min(_MAX_EXPONENT, (max(shared) if shared else 2) + 2), n


def _site_blocks(sites: DataFrame, level_deg: float) -> DataFrame:
    """Each site once per block (3x3 cells, wrapping in longitude) that contains it."""
    nx = int(round(360.0 / level_deg))
    ny = max(1, nx // 2)
    sx, sy = _cell_index(F.col("__slat"), F.col("__slon"), level_deg)
    offs = F.array(F.lit(-1), F.lit(0), F.lit(1))
    bx = F.array_distinct(F.transform(offs, lambda d: F.pmod(sx + d, F.lit(nx))))
    by = F.filter(F.transform(offs, lambda d: sy + d), lambda v: (v >= 0) & (v < ny))
    return (sites.withColumn("__bx", F.explode(bx)).withColumn("__by", F.explode(by)))


def _guaranteed_radius(x0: Column, y0: Column, d0: float, level: int) -> Column:
    """Lower bound (km) on the distance from fine cell (x0, y0) to any site outside its level block."""
    dl = d0 * (2 ** level)
    ax = F.shiftright(x0, level)
    ay = F.shiftright(y0, level)
    cell_lat_lo = y0 * F.lit(d0) - 90.0
    cell_lat_hi = (y0 + 1) * F.lit(d0) - 90.0
    band_lat_lo = (ay - 1) * F.lit(dl) - 90.0
    band_lat_hi = (ay + 2) * F.lit(dl) - 90.0
    inf = F.lit(float("inf"))
    below = F.when(band_lat_lo <= -90.0, inf).otherwise(F.radians(cell_lat_lo - band_lat_lo) * EARTH_RADIUS_KM)
    above = F.when(band_lat_hi >= 90.0, inf).otherwise(F.radians(band_lat_hi - cell_lat_hi) * EARTH_RADIUS_KM)
    lat_bound = F.least(below, above)
    if 3 * dl >= 360.0:
        return lat_bound
    cell_lon_lo = x0 * F.lit(d0) - 180.0
    cell_lon_hi = (x0 + 1) * F.lit(d0) - 180.0
    band_lon_lo = (ax - 1) * F.lit(dl) - 180.0
    band_lon_hi = (ax + 2) * F.lit(dl) - 180.0
    dlon = F.least(cell_lon_lo - band_lon_lo, band_lon_hi - cell_lon_hi)
    phi_max = F.least(F.greatest(F.abs(band_lat_lo), F.abs(band_lat_hi)), F.lit(90.0))
    lon_bound = 2 * EARTH_RADIUS_KM * F.asin(F.cos(F.radians(phi_max)) * F.sin(F.radians(dlon) / 2))
    return F.least(lat_bound, lon_bound)


def _cell_radius(y0: Column, d0: float) -> Column:
    """Upper bound (km) on the distance from a fine cell's centre to any point of the cell.

    For p in the cell |dlat|, |dlon| <= d0/2, so by the haversine formula
    sin^2(d/2) <= sin^2(d0/4) * (1 + cos(lat_centre) * cos(lat_nearest_equator)).
    """
    lat_lo = y0 * F.lit(d0) - 90.0
    lat_hi = lat_lo + d0
    near = F.when((lat_lo <= 0) & (lat_hi >= 0), F.lit(0.0)).otherwise(F.least(F.abs(lat_lo), F.abs(lat_hi)))
    centre = lat_lo + d0 / 2
    s = math.sin(math.radians(d0) / 4) * F.sqrt(1 + F.cos(F.radians(centre)) * F.cos(F.radians(near)))
    return 2 * EARTH_RADIUS_KM * F.asin(F.when(s > 1, F.lit(1.0)).otherwise(s))


def _kth_smallest(rows: DataFrame, keys: Sequence[str], value: Column, k: int) -> DataFrame:
    """``keys`` and ``__bound``, the k-th smallest value of each (infinity where there are fewer).

    Both forms shuffle at most k values per key and map task.
    """
    if k == 1:
        return rows.groupBy(*keys).agg(F.min(value).alias("__bound"))
    w = Window.partitionBy(*keys).orderBy("__v")
    least = rows.select(*keys, value.alias("__v")).withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k)
    full = F.count(F.lit(1)) == k
    return least.groupBy(*keys).agg(F.when(full, F.max("__v")).otherwise(F.lit(float("inf"))).alias("__bound"))


def _by_level(levels: Sequence[int], value: Callable[[int], Column]) -> Column:
    """``value`` of the row's level (``__lvl``)."""
    out = F.when(F.col("__lvl") == levels[0], value(levels[0]))
    for level in levels[1:]:
        out = out.when(F.col("__lvl") == level, value(level))
    return out


def candidate_cells(cells: DataFrame, sites: DataFrame, exponent: int, carry: Sequence[str], site_bytes: int, k: int = 1,
                    start_level: int = 1, levels_per_job: int = 3, later_levels_per_job: int = 5) -> tuple[DataFrame, int]:
    """Candidate sites per occupied cell: (``__x0``, ``__y0``, ``__cands`` array<struct>), and its bytes.

    ``cells`` holds distinct (``__x0``, ``__y0``) at the finest level;
    ``sites`` (a written table of ``site_bytes``) holds ``__slat``, ``__slon``
    and the ``carry`` columns. The candidates hold the ``k`` nearest sites of
    every point of the cell.

    Levels are tried in batches (``levels_per_job`` levels first, then
    ``later_levels_per_job`` per batch for the cells still far from every
    site). In the first batch the search unit is the fine cell. Beyond it, at
    level l, the unit is the level ``l - 2`` cell holding the fine cell, so
    cells far from every site, which climb to coarse levels, share few units
    and pair with each site once per unit.

    A unit resolves when the k-th smallest upper bound of its level-l block
    beats the block's guaranteed radius; each fine cell takes its lowest
    resolved level. Only then are candidates (``lb <= bound``) gathered, and
    fine cells of coarser units re-prune them with their own bounds. One job
    evaluates a batch; the result is checkpointed (its size and unresolved
    count observed by the same job) and the next batch reads the unresolved
    cells from it.
    """
    d0 = 360.0 / (2 ** exponent)
    carried = ["__slat", "__slon", *carry]
    site_struct = F.struct(*[F.col(f"`{c}`") for c in carried])
    cell = ["__x0", "__y0"]
    top = exponent - 1  # level whose cells are 180 degrees: the block is the globe
    inf = F.lit(float("inf"))
    resolved_parts: list[DataFrame] = []
    resolved_bytes = 0
    pending = cells
    batch_start = first = min(start_level, top)
    while batch_start <= top:
        identity = batch_start == first  # first batch: every unit is a fine cell
        width = levels_per_job if identity else later_levels_per_job  # far cells climb faster
        levels = list(range(batch_start, min(batch_start + width, top + 1)))
        batch_start += width
        ux, uy = cell if identity else ("__ux", "__uy")
        unit = ["__lvl", ux, uy]
        lags = {level: level if identity else min(level, _UNIT_LAG) for level in levels}
        size = {level: d0 * (2 ** (level - lags[level])) for level in levels}  # of a unit cell, in degrees
        # Site blocks are 9 rows per site and level: broadcast them only under a measured bound.
        hint = "broadcast" if 9 * len(levels) * (site_bytes + 32) <= DEFAULT_MAX_BROADCAST_BYTES else "merge"
        blocks = reduce(DataFrame.unionByName, [
            _site_blocks(sites, d0 * (2 ** level)).withColumn("__lvl", F.lit(level)) for level in levels])

        def paired(units: DataFrame) -> DataFrame:
            """Units with the sites of their blocks, the distance of the centres and the unit's radius."""
            lat, lon = ((F.col(c) + 0.5) * _by_level(levels, lambda at: F.lit(size[at])) - o for c, o in ((uy, 90.0), (ux, 180.0)))
            return (units.withColumns({b: _by_level(levels, lambda at, u=u: F.shiftright(u, lags[at])) for b, u in (("__bx", ux), ("__by", uy))})
                    .join(blocks.hint(hint), ["__lvl", "__bx", "__by"], "inner")
                    .withColumn("__rc", _by_level(levels, lambda at: _cell_radius(F.col(uy), size[at])))
                    .withColumn("__dc", haversine_km(lat, lon, F.col("__slat"), F.col("__slon"))))

        mapping = pending.withColumn("__lvl", F.explode(F.array(*[F.lit(level) for level in levels])))
        if not identity:
            mapping = mapping.withColumns({u: _by_level(levels, lambda at, x=x: F.shiftright(x, at - lags[at])) for u, x in zip((ux, uy), cell)})
        units = mapping.select(*unit) if identity else mapping.select(*unit).distinct()
        upper, lower = F.col("__dc") + F.col("__rc"), F.col("__dc") - F.col("__rc")
        radius = _by_level(levels, lambda at: _guaranteed_radius(F.col(ux), F.col(uy), size[at], lags[at]) if at < top else inf)
        enough = (F.col("__g") == inf) | (F.col("__bound") + _EPS_KM < F.col("__g") - _EPS_KM)
        bounds = _kth_smallest(paired(units), unit, upper, k).withColumn("__g", radius).filter(enough).drop("__g")
        lowest = ["__lvl", "__bound"] if identity else ["__lvl", ux, uy, "__bound"]
        chosen = ((bounds if identity else mapping.join(bounds, unit)).groupBy(*cell)
                  .agg(F.min(F.struct(*lowest)).alias("__of")).select(*cell, "__of.*"))
        within = lower <= F.col("__bound") + _EPS_KM
        if identity:
            kept = paired(chosen).filter(within)
        else:
            # A unit's candidates hold those of every fine cell in it; each prunes them with its own tighter bounds.
            of_unit = materialize(paired(chosen.select(*unit, "__bound").distinct()).filter(within).select(*unit, *[F.col(f"`{c}`") for c in carried]))
            clat, clon = (F.col("__y0") + 0.5) * F.lit(d0) - 90.0, (F.col("__x0") + 0.5) * F.lit(d0) - 180.0
            fine = (chosen.drop("__bound").join(of_unit, unit)
                    .withColumn("__rc", _cell_radius(F.col("__y0"), d0))
                    .withColumn("__dc", haversine_km(clat, clon, F.col("__slat"), F.col("__slon"))))
            kept = fine.join(_kth_smallest(fine, cell, upper, k), cell).filter(within)
        resolved = kept.groupBy(*cell).agg(F.collect_list(site_struct).alias("__cands"))
        per_cell = pending.join(resolved, cell, "left")
        result, seen = materialize_counted(per_cell, unresolved=F.count_if(F.col("__cands").isNull()),
                                           bytes=F.sum(F.when(F.col("__cands").isNotNull(), row_bytes(per_cell))))
        resolved_parts.append(result.filter(F.col("__cands").isNotNull()))
        resolved_bytes += int(seen["bytes"] or 0)
        if seen["unresolved"] == 0:
            break
        pending = result.filter(F.col("__cands").isNull()).select(*cell)
    return reduce(DataFrame.unionByName, resolved_parts), resolved_bytes


@dataclass
class SiteGrid:
    """Valid sites, at most ``k`` per location (``__slat``, ``__slon`` + carried columns), and the grid exponent.

    ``sites`` is a written table; ``index`` holds the candidate cells that
    earlier queries on the same sites left.
    """

    sites: DataFrame
    exponent: int | None
    carry: list[str]
    site_count: int
    site_bytes: int
    index: SiteIndex
    k: int = 1

    @classmethod
    def build(cls, sites: DataFrame, site_lat: str, site_lon: str, carry: Sequence[str],
              cell_deg: float | None = None, k: int = 1, index_folder: str | None = None) -> SiteGrid:
        carry = list(dict.fromkeys(carry))
        valid = (sites.filter(is_valid_coordinate(site_lat, site_lon)
                              & F.col(f"`{site_lat}`").between(-90.0, 90.0))
                 .select(F.col(f"`{site_lat}`").cast("double").alias("__slat"),
                         F.col(f"`{site_lon}`").cast("double").alias("__slon"),
                         *[F.col(f"`{c}`") for c in carry]))
        # Sites sharing a location are always tied; only the first ``k`` in ``carry`` order
        # (tie-break columns first) can win, so no more rows per location are kept. This
        # bounds every candidate list by distinct locations, however many copies exist.
        named = [F.col(f"`{c}`") for c in carry]
        if k == 1:
            per_location = (valid.groupBy("__slat", "__slon").agg(F.min(F.struct(*named)).alias("__site"))
                            .select("__slat", "__slon", *[F.col("__site")[c].alias(c) for c in carry]))
        else:
            w = Window.partitionBy("__slat", "__slon").orderBy(*named)
            per_location = valid.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k).drop("__r")
        written, seen = materialize_counted(per_location, bytes=F.sum(row_bytes(per_location)), **fingerprint_metrics(per_location))
        told = fingerprint_of(per_location, seen, k, cell_deg)
        index = SiteIndex.at(sites.sparkSession, told, index_folder)
        exponent = None
        if seen["rows"]:
            exponent = index.exponent or _choose_exponent(written.select("__slat", "__slon"), "__slat", "__slon", cell_deg)[0]
        return cls(written, exponent, carry, seen["rows"], int(seen["bytes"] or 0), index, k)

    @property
    def cell_deg(self) -> float:
        return 360.0 / (2 ** self.exponent)

    def assign_cells(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """``df`` plus its finest-level cell (``__x0``, ``__y0``); NULL for unusable coordinates."""
        la, lo = F.col(f"`{lat}`"), F.col(f"`{lon}`")
        ok = is_valid_coordinate(la, lo) & la.between(-90.0, 90.0) & (F.abs(lo) < F.lit(float("inf")))
        x0, y0 = _cell_index(la, lo, self.cell_deg)
        return df.withColumns({"__x0": F.when(ok, x0), "__y0": F.when(ok, y0)})

    def candidate_table(self, cover: DataFrame, lat: str, lon: str) -> tuple[DataFrame, int]:
        """Candidate table for (at least) the cells that ``cover``'s coordinates occupy, and its bytes.

        Cells that the index holds are taken from it; the others are built and added to it.
        """
        cells = (self.assign_cells(cover.select(lat, lon), lat, lon)
                 .filter(F.col("__x0").isNotNull()).select("__x0", "__y0").distinct())
        held, size = self.index.cells()
        if held is not None:
            known = held.select("__x0", "__y0")
            known = F.broadcast(known) if size <= DEFAULT_MAX_BROADCAST_BYTES else known
            cells = cells.join(known, ["__x0", "__y0"], "left_anti")
        missing, seen = materialize_counted(cells)
        if seen["rows"] or held is None:
            built, size = candidate_cells(missing, self.sites, self.exponent, self.carry, self.site_bytes, self.k)
            self.index.add(built, size, self.exponent)
            held, size = self.index.cells()
        return held, size

    def candidates(self, cover: DataFrame, lat: str, lon: str,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
        """Candidate table, hinted broadcast only when its measured bytes are within the bound."""
        cands, size = self.candidate_table(cover, lat, lon)
        return F.broadcast(cands) if size <= max_broadcast_bytes else cands.hint("merge")


def nearest_site(points: DataFrame, sites: DataFrame, *, point_lat: str = "LAT", point_lon: str = "LON",
                 site_lat: str = "Y", site_lon: str = "X", site_cols: Sequence[str] = ("DIVISION",),
                 tie_break: Sequence[str] | None = None, distance_col: str = "distance",
                 cell_deg: float | None = None, cover: DataFrame | None = None,
                 max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, when_no_sites: str = "null",
                 index_folder: str | None = None) -> DataFrame:
    """``points`` plus the nearest site's ``site_cols`` and the distance in km.

    When no site has usable coordinates, ``when_no_sites="null"`` keeps every
    point with NULL site columns, and ``"drop"`` returns no rows (the result a
    pairing of every point with every site would give).

    ``tie_break`` (default ``site_cols``) orders sites at equal distance.
    ``cell_deg`` sets the finest grid cell; by default it is derived from the
    sites' extent and count (about one site per cell). ``cover`` optionally
    names a cheaper DataFrame whose coordinates include every point's (e.g.
    the raw scan before de-duplication and filters); occupied cells are taken
    from it so the points' own lineage runs once. ``index_folder`` names a
    shared folder in which candidate cells outlive the application; by default
    they are kept in its checkpoint folder.
    """
    joined, scored, types = _scored(points, sites, point_lat, point_lon, site_lat, site_lon, site_cols, tie_break,
                                    [distance_col, *site_cols], cell_deg, cover, max_broadcast_bytes, 1, index_folder)
    if scored is None:
        out = points.withColumns({c: F.lit(None).cast(types[c]) for c in site_cols}
                                 | {distance_col: F.lit(None).cast("double")})
        return out.filter(F.lit(False)) if when_no_sites == "drop" else out
    return (joined.withColumn("__best", F.array_min(scored))
            .withColumns({c: F.col("__best")[c] for c in site_cols} | {distance_col: F.col("__best")["__d"]})
            .drop("__best", "__cands", "__x0", "__y0"))


def nearest_sites(points: DataFrame, sites: DataFrame, k: int, *, point_lat: str = "LAT", point_lon: str = "LON",
                  site_lat: str = "Y", site_lon: str = "X", site_cols: Sequence[str] = ("DIVISION",),
                  tie_break: Sequence[str] | None = None, distance_col: str = "distance", out_col: str = "nearest",
                  cell_deg: float | None = None, cover: DataFrame | None = None,
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, index_folder: str | None = None) -> DataFrame:
    """``points`` plus ``out_col``: the ``k`` nearest sites, nearest first, as structs of the distance and ``site_cols``.

    The array has fewer than ``k`` elements where there are fewer sites, none
    when no site has usable coordinates, and is NULL for points without. Sites
    at one location count each. Other parameters as for ``nearest_site``.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    joined, scored, types = _scored(points, sites, point_lat, point_lon, site_lat, site_lon, site_cols, tie_break,
                                    [out_col], cell_deg, cover, max_broadcast_bytes, k, index_folder)
    if scored is None:
        fields = ", ".join(f"`{c}`: {t}" for c, t in {distance_col: "double", **{c: types[c].simpleString() for c in site_cols}}.items())
        ok = is_valid_coordinate(F.col(f"`{point_lat}`"), F.col(f"`{point_lon}`"))
        return points.withColumn(out_col, F.when(ok, F.array().cast(f"array<struct<{fields}>>")))
    told = F.transform(F.slice(F.array_sort(scored), 1, k), lambda s: F.struct(s["__d"].alias(distance_col), *[s[c].alias(c) for c in site_cols]))
    return joined.withColumn(out_col, told).drop("__cands", "__x0", "__y0")


def _scored(points: DataFrame, sites: DataFrame, point_lat: str, point_lon: str, site_lat: str, site_lon: str,
            site_cols: Sequence[str], tie_break: Sequence[str] | None, made: Sequence[str], cell_deg: float | None,
            cover: DataFrame | None, max_broadcast_bytes: int, k: int, index_folder: str | None) -> tuple[DataFrame, Column | None, dict]:
    """Points with their cell's candidates, the candidates as structs in order of nearness, and the sites' types.

    Without usable sites the column is None.
    """
    tie_break = list(tie_break if tie_break is not None else site_cols)
    clash = [c for c in dict.fromkeys([*tie_break, *made]) if c in points.columns]
    if clash:
        raise ValueError(f"site columns {clash} also exist on points; rename them first")
    grid = SiteGrid.build(sites, site_lat, site_lon, [*tie_break, *site_cols], cell_deg, k, index_folder)
    types = {f.name: f.dataType for f in grid.sites.schema}
    if grid.exponent is None:
        return points, None, types
    keyed = grid.assign_cells(points, point_lat, point_lon)
    cands = grid.candidates(cover if cover is not None else points, point_lat, point_lon, max_broadcast_bytes)
    plat, plon = F.col(f"`{point_lat}`"), F.col(f"`{point_lon}`")
    scored = F.transform(F.col("__cands"), lambda s: F.struct(
        haversine_km(plat, plon, s["__slat"], s["__slon"]).alias("__d"),
        *[s[c].alias(f"__t{i}") for i, c in enumerate(tie_break)],
        *[s[c].alias(c) for c in site_cols]))
    return keyed.join(cands, ["__x0", "__y0"], "left"), scored, types


def candidate_rows(candidates: DataFrame) -> DataFrame:
    """Candidate table flattened to one row per (cell, site), for SQL joins."""
    return candidates.select("__x0", "__y0", F.inline("__cands"))
