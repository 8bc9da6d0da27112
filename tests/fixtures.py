"""CSV fixture rows (invented) for the incident, income, reverse-geocode and station files."""

from __future__ import annotations

import csv
from pathlib import Path

from blotter import schemas

INCIDENT_COLUMNS = [f.name for f in schemas.INCIDENT]

# (DR_NO, Date Rptd, DATE OCC, TIME OCC, AREA, Vict Descent, Premis Desc, Weapon Used Cd, LAT, LON)
INCIDENT_ROWS = [
    ("1", "02/20/2015 12:00:00 AM", "02/19/2015 12:00:00 AM", "0359", "1", "H", "STREET", "102", "34.05", "-118.25"),
    ("2", "02/20/2015 12:00:00 AM", "02/20/2015 01:05:09 PM", "0430", "1", "W", "STREET", "200", "34.05", "-118.25"),
    ("3", "03/01/2016 12:00:00 AM", "12/31/2015 12:00:00 AM", "0500", "2", "Q", "STREET", "", "34.10", "-118.30"),
    ("4", "03/01/2016 12:00:00 AM", "03/01/2016 12:00:00 AM", "1159", "99", "", "street", "199", "34.10", "-118.30"),
    ("5", "not a date", "03/01/2016 12:00:00 AM", "x", "2", "X", "STREET", "abc", "", ""),
    ("6", "03/01/2016 12:00:00 AM", "03/01/2016 12:00:00 AM", "2100", "1", "A", "STREET", "100", "0", "0"),
]
# Row 3 again: appears in both period files.
DUPLICATE_IN_SECOND = INCIDENT_ROWS[2]


def incident_record(row: tuple[str, ...]) -> dict[str, str]:
    dr, rptd, occ, time_occ, area, descent, premis, weapon, lat, lon = row
    rec = {c: "" for c in INCIDENT_COLUMNS}
    rec.update({"DR_NO": dr, "Date Rptd": rptd, "DATE OCC": occ, "TIME OCC": time_occ, "AREA": area,
                "AREA NAME": f"Area {area}", "Vict Descent": descent, "Premis Desc": premis,
                "Weapon Used Cd": weapon, "LAT": lat, "LON": lon, "Crm Cd": "510", "Vict Age": "30"})
    return rec


def _write(path: Path, header: list[str], records: list[list[str]]) -> str:
    with path.open("w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(records)
    return str(path)


def write_incident_periods(folder: Path) -> tuple[str, str]:
    first = [[incident_record(r)[c] for c in INCIDENT_COLUMNS] for r in INCIDENT_ROWS[:4]]
    second = [[incident_record(r)[c] for c in INCIDENT_COLUMNS] for r in [DUPLICATE_IN_SECOND, *INCIDENT_ROWS[4:]]]
    header_first = ["AREA " if c == "AREA" else c for c in INCIDENT_COLUMNS]  # trailing blank, as in one real file
    return (_write(folder / "period_2010.csv", header_first, first),
            _write(folder / "period_2020.csv", INCIDENT_COLUMNS, second))


INCOME_ROWS = [
    ("90001", "Sample A", "$12,000"), ("90002", "Sample B", "$12,000"), ("90003", "Sample C", "$30,500"),
    ("90004", "Sample D", "$41,000"), ("90005", "Sample, with comma", "$55,250"), ("90006", "Sample F", "$99,999"),
    ("90007", "Sample G", "$102,406"), ("91046", "Sample H", "$5"), ("", "Sample I", "n/a"),
]
REVGEO_ROWS = [("34.05", "-118.25", "90001"), ("34.05", "-118.25", "90007"), ("34.10", "-118.30", "90003")]
STATION_ROWS = [
    ("-118.25", "34.05", "1", "ALPHA", "1 Sample St", "1"),
    ("-118.30", "34.10", "2", "BRAVO", "2 Sample St", "2"),
    ("-118.30", "34.10", "3", "CHARLIE", "3 Sample St", "3"),
    ("", "", "4", "DELTA", "4 Sample St", "4"),
]


def write_dimensions(folder: Path) -> dict[str, str]:
    return {
        "income": _write(folder / "income.csv", [f.name for f in schemas.INCOME], [list(r) for r in INCOME_ROWS]),
        "revgeo": _write(folder / "revgeo.csv", [f.name for f in schemas.REVGEO], [list(r) for r in REVGEO_ROWS]),
        "stations": _write(folder / "stations.csv", [f.name for f in schemas.STATION],
                           [list(r) for r in STATION_ROWS]),
    }
