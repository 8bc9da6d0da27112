"""Q0 and the ingest-level operators: counts, schema report, typing, unions, filters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.filters import drop_missing, exclude_keys, in_range
from ..operators.profile import schema_report
from ..session import ensure_checkpoint_dir
from ..sources.csv import (csv_file_roundtrip, csv_text_roundtrip, read_incidents, read_incidents_with_rejects, typed_column,
                           typed_select)
from ..sources.periods import tag_and_union, union_periods


def profile_counts(periods: Sequence[DataFrame]) -> DataFrame:
    """Row count of each period table and of their de-duplicated union, in one pass over each.

    Rows are grouped once with a count per period; the counts' sums are the periods' rows, the groups the distinct ones.
    """
    tag = "__period"
    tagged = tag_and_union([(str(i), p) for i, p in enumerate(periods)], tag)
    columns = [F.col(f"`{c}`") for c in tagged.columns if c != tag]
    rows = tagged.groupBy(*columns).agg(*[F.count_if(F.col(tag) == str(i)).alias(f"__n{i}") for i in range(len(periods))])
    totals = rows.agg(*[F.coalesce(F.sum(f"__n{i}"), F.lit(0)).alias(f"__n{i}") for i in range(len(periods))],
                      F.count(F.lit(1)).alias("__distinct"))
    named = [(f"period_{i + 1}", f"__n{i}") for i in range(len(periods))] + [("incidents", "__distinct")]
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("table"), F.col(c).alias("row_count")) for name, c in named])))


def incidents_schema_report(periods: Sequence[DataFrame]) -> DataFrame:
    return schema_report(union_periods(periods))


def typed_income(income_text: DataFrame) -> DataFrame:
    """Income with money text parsed to an integer."""
    return typed_select(income_text, schemas.INCOME, money_columns=schemas.MONEY_COLUMNS)


def parse_money_report(income_text: DataFrame) -> DataFrame:
    typed = typed_income(income_text)
    return typed.select(F.col("`Zip Code`").alias("zip_code"),
                        F.col("`Estimated Median Income`").alias("income"))


def parse_timestamp_report(incidents: DataFrame, key: str = "DR_NO", date_col: str = "DATE OCC") -> DataFrame:
    """Render a timestamp as incident-file text and parse it back (timestamp and date)."""
    text = F.date_format(F.col(f"`{date_col}`"), schemas.INCIDENT_TS_PATTERN)
    staged = incidents.select(F.col(key).alias("dr_no"), text.alias("date_text"))
    return staged.select(
        "dr_no", "date_text",
        typed_column("occurred", T.TimestampNTZType(), F.col("date_text"), schemas.INCIDENT_TS_PATTERN),
        typed_column("occurred_date", T.DateType(), F.col("date_text"), schemas.INCIDENT_TS_PATTERN),
    )


def csv_roundtrip(df: DataFrame) -> DataFrame:
    return csv_text_roundtrip(df)


def csv_file_roundtrip_report(df: DataFrame) -> DataFrame:
    """``df`` written as CSV files under the session's checkpoint folder and read back typed."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/csv-roundtrip-{uuid.uuid4().hex[:12]}"
    return csv_file_roundtrip(df, folder)


def union_fold(periods: Sequence[DataFrame]) -> DataFrame:
    return tag_and_union([(f"period_{i + 1}", p) for i, p in enumerate(periods)])


def located_firearm_incidents(incidents: DataFrame) -> DataFrame:
    """Firearm incidents with usable coordinates (no NULL, no NaN)."""
    kept = drop_missing(incidents.filter(in_range("Weapon Used Cd", 100, 199)), ["LAT", "LON"])
    return kept.select("DR_NO", "Weapon Used Cd", "LAT", "LON")


def income_without(income: DataFrame, zips: Sequence[int]) -> DataFrame:
    kept = exclude_keys(income, "Zip Code", zips)
    return kept.select(F.col("`Zip Code`").alias("zip_code"),
                       F.col("`Estimated Median Income`").alias("income"))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _as_text(period: DataFrame) -> list[Column]:
    """The period's columns as the text of a 28-column incident file; columns it lacks are empty."""
    text = []
    for f in schemas.INCIDENT:
        if f.name not in period.columns:
            text.append(F.lit(None).cast("string").alias(f.name))
        elif f.name in schemas.TIMESTAMP_PATTERNS:
            text.append(F.date_format(F.col(f"`{f.name}`"), schemas.TIMESTAMP_PATTERNS[f.name]).alias(f.name))
        else:
            text.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
    return text


def _write_periods(periods: Sequence[DataFrame], mixed: bool = False, marred: str | None = None) -> list[str]:
    """Each period as incident files in a folder of its own; the first one's header has a blank after AREA.

    ``mixed`` writes the columns of every other period in reverse order;
    ``marred`` names a column whose text is replaced by what is not its type
    in rows whose key 13 divides.
    """
    folder, out = _scratch(periods[0].sparkSession, "incident-files"), []
    for i, period in enumerate(periods):
        rows = period.select(*_as_text(period))
        if marred:
            rows = rows.withColumn(marred, F.when(F.col("DR_NO") % 13 == 0, F.lit("n/a")).otherwise(F.col(f"`{marred}`")))
        names = schemas.INCIDENT.names[::-1] if mixed and i % 2 else schemas.INCIDENT.names
        named = [F.col(f"`{c}`").alias("AREA " if i == 0 and c == "AREA" else c) for c in names]
        rows.select(*named).write.option("header", "true").csv(f"{folder}/{i}")
        out.append(f"{folder}/{i}")
    return out


def _like(read: DataFrame, period: DataFrame) -> DataFrame:
    dates = {c: F.col(f"`{c}`").cast("timestamp_ntz") for c in schemas.TIMESTAMP_PATTERNS if c in read.columns}
    return read.withColumns(dates).select(*[F.col(f"`{c}`") for c in period.columns if c in read.columns])


def incident_files(periods: Sequence[DataFrame]) -> DataFrame:
    """Period tables written as 28-column incident files, each read by ``read_incidents``, and united."""
    spark = periods[0].sparkSession
    return _like(union_periods([read_incidents(spark, folder) for folder in _write_periods(periods)]), periods[0])


def mixed_header_files(periods: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Files of different column order read by one ``read_incidents`` call over all their folders, duplicates removed."""
    read = read_incidents(periods[0].sparkSession, _write_periods(periods, mixed=True), columns=columns)
    return _like(union_periods([read]), periods[0])


def rejected_fields(periods: Sequence[DataFrame], marred: str = "Weapon Used Cd") -> DataFrame:
    """Rows, and rows with a rejected field, by the field's name and whether the row's other fields survived."""
    read = read_incidents_with_rejects(periods[0].sparkSession, _write_periods(periods, mixed=True, marred=marred))
    told = read.select(
        F.explode_outer("rejected_fields").alias("field"),
        (F.col("DR_NO").isNotNull() & F.col("LON").isNotNull()).alias("others_kept"),
        F.col("_corrupt_record").isNotNull().alias("broken_line"))
    return told.groupBy("field", "others_kept", "broken_line").agg(F.count(F.lit(1)).alias("row_count"))


def dimension_file(df: DataFrame, reader: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """``df`` written as a CSV file with a header and read by its reader."""
    folder = _scratch(df.sparkSession, "dimension-file")
    df.write.option("header", "true").csv(folder)
    return reader(df.sparkSession, folder)
