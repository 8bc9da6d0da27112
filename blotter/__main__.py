"""Run the incident questions on CSV files: ``python -m blotter <question> [options]``.

Each question reads the period files (and dimension files) given as paths,
runs the library's plan and either writes the result as Parquet (``--out``)
or shows it. Paths may be any Hadoop-FS URI. Examples::

    python -m blotter profile --incidents p2010.csv p2020.csv
    python -m blotter top-months --incidents p2010.csv p2020.csv --k 3
    python -m blotter part-of-day --incidents p2010.csv --api sql
    python -m blotter descent --incidents p2010.csv --income income.csv --revgeo revgeo.csv \\
        --year 2015 --exclude 91046 91210 --strategy merge
    python -m blotter responsible --incidents p2010.csv p2020.csv --stations st.csv --by year
    python -m blotter nearest --incidents p2010.csv p2020.csv --stations st.csv --by division
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Absolute imports: the file also runs as a spark-submit script with blotter on --py-files.
from blotter.operators.joins import RESTRICTING
from blotter.plans import descent, ingest, months, part_of_day, stations
from blotter.sources.csv import CORRUPT, read_incidents, read_incidents_with_rejects, read_income, read_revgeo, read_stations
from blotter.sources.periods import union_periods


def _incidents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files in one read, each by its own header."""
    return union_periods([read_incidents(spark, paths)])


def build(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    q = args.question
    if q == "profile":
        return ingest.profile_counts([read_incidents(spark, p) for p in args.incidents])
    if q == "schema":
        return ingest.incidents_schema_report([read_incidents(spark, p) for p in args.incidents])
    if q == "rejects":
        read = read_incidents_with_rejects(spark, args.incidents)
        return read.filter((F.size("rejected_fields") > 0) | F.col(CORRUPT).isNotNull())
    inc = _incidents(spark, args.incidents)
    if q == "top-months":
        fn = months.top_months_per_year_sql if args.api == "sql" else months.top_months_per_year
        return fn(inc, args.k, args.date_column)
    if q == "part-of-day":
        fn = {"dataframe": part_of_day.street_by_part_of_day, "sql": part_of_day.street_by_part_of_day_sql,
              "rdd": part_of_day.street_by_part_of_day_rdd, "arrow": part_of_day.street_by_part_of_day_arrow}[args.api]
        return fn(inc, args.premise)
    if q == "descent":
        return descent.dim_restricted_counts(inc, read_revgeo(spark, args.revgeo), read_income(spark, args.income),
                                             year=args.year, k=args.k, exclude_zips=args.exclude,
                                             strategy=args.strategy)
    st = read_stations(spark, args.stations)
    if q == "responsible":
        if args.api == "sql":
            return (stations.responsible_by_year_sql if args.by == "year" else stations.responsible_by_division_sql)(
                inc, st)
        fn = stations.responsible_by_year if args.by == "year" else stations.responsible_by_division
        return fn(inc, st, args.strategy)
    if q == "nearest":
        # every coordinate, without the whole-row distinct: occupied cells come from two columns of the raw files
        cover = read_incidents(spark, args.incidents, columns=["LAT", "LON"])
        if args.by == "rank":
            return stations.nearest_k_by_division(inc, st, args.k, cover)
        if args.by == "year":
            fn = stations.nearest_by_year_sql if args.api == "sql" else stations.nearest_by_year
        else:
            fn = stations.nearest_by_division_sql if args.api == "sql" else stations.nearest_by_division
        return fn(inc, st, cover)
    raise ValueError(f"unknown question {q!r}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m blotter", description=__doc__.split("\n")[0])
    p.add_argument("question", choices=["profile", "schema", "rejects", "top-months", "part-of-day", "descent",
                                        "responsible", "nearest"])
    p.add_argument("--incidents", nargs="+", required=True, help="period files (CSV with a header)")
    p.add_argument("--income")
    p.add_argument("--revgeo")
    p.add_argument("--stations")
    p.add_argument("--api", choices=["dataframe", "sql", "rdd", "arrow"], default="dataframe")
    p.add_argument("--strategy", choices=[*RESTRICTING, "salted"], default="auto",
                   help="bloom is for descent, salted for responsible")
    p.add_argument("--by", choices=["year", "division", "rank"], default="year", help="rank: the k nearest divisions")
    p.add_argument("--k", type=int, default=3)
    p.add_argument("--date-column", default=months.REPORTED, help="date whose months top-months counts")
    p.add_argument("--year", type=int, default=2015)
    p.add_argument("--exclude", type=int, nargs="*", default=[91046, 91210])
    p.add_argument("--premise", default="STREET")
    p.add_argument("--out", help="write the result as Parquet here instead of showing it")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"blotter-{args.question}").getOrCreate()
    result = build(spark, args)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        result.show(truncate=False)
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
