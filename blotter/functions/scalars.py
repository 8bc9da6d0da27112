"""Scalar column expressions (JVM-side, codegen'd; no Python in the hot path).

Every function takes and returns ``Column`` s so it composes inside one
``select`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values (must equal the reference's for equal results) -----------------
# Mean Earth radius used by the great-circle distance, in kilometres.
EARTH_RADIUS_KM = 6371.0
# Part-of-day buckets on an HHMM clock, inclusive bounds, in order of evaluation:
# Morning 500-1159, Afternoon 1200-1659, Evening 1700-2059, Night 2100 and later or 359 and earlier.
# 400-459 falls in no bucket and yields NULL.
PART_OF_DAY_RANGES = (("Morning", 500, 1159), ("Afternoon", 1200, 1659), ("Evening", 1700, 2059))
NIGHT_LABEL, NIGHT_FROM, NIGHT_UNTIL = "Night", 2100, 359
# Victim descent codes and their labels; codes not listed pass through unchanged.
DESCENT_LABELS = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}
# ---------------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hhmm(ts: ColumnOrName) -> Column:
    """Clock time of a timestamp as an HHMM integer (0..2359)."""
    t = _c(ts)
    return F.hour(t) * 100 + F.minute(t)


def part_of_day(clock: ColumnOrName) -> Column:
    """Bucket an HHMM integer into Morning / Afternoon / Evening / Night; NULL outside."""
    c = _c(clock)
    expr = None
    for label, lo, hi in PART_OF_DAY_RANGES:
        cond = (c >= lo) & (c <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when((c >= NIGHT_FROM) | (c <= NIGHT_UNTIL), NIGHT_LABEL)


def parse_money(text: ColumnOrName, to: str = "int") -> Column:
    """Money text such as ``"$12,000"`` to a number; malformed text becomes NULL."""
    return F.regexp_replace(_c(text), r"[$,]", "").try_cast(to)


def format_money(amount: ColumnOrName) -> Column:
    """Whole currency units rendered as money text, e.g. 12000 -> ``"$12,000"``."""
    return F.concat(F.lit("$"), F.format_number(_c(amount), 0))


def code_label(code: ColumnOrName, labels: Mapping[str, str] = DESCENT_LABELS) -> Column:
    """Replace a code by its label; unknown codes pass through, NULL stays NULL."""
    c = _c(code)
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.when(c.isNotNull(), F.coalesce(F.try_element_at(table, c), c))


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """Great-circle distance in km between two points given in degrees.

    NULL in any coordinate gives NULL. The root is clamped to 1 with a CASE so
    rounding cannot push ``asin`` out of its domain (``least`` would turn a NULL
    into 1.0).
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    l1, l2 = F.radians(_c(lon1)), F.radians(_c(lon2))
    dlat = p2 - p1
    dlon = l2 - l1
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    root = F.sqrt(a)
    return 2 * F.asin(F.when(root > 1, F.lit(1.0)).otherwise(root)) * F.lit(EARTH_RADIUS_KM)


def is_valid_coordinate(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """True when both coordinates are present and not NaN."""
    la, lo = _c(lat), _c(lon)
    return la.isNotNull() & lo.isNotNull() & ~F.isnan(la) & ~F.isnan(lo)
