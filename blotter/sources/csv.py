"""CSV ingest: read text by header name, then type it tolerantly.

Spark 4 runs in ANSI mode, where ``cast`` and ``to_timestamp`` raise on bad
text. Files from the field are dirty, so typing uses ``try_cast`` /
``try_to_timestamp``: a malformed field becomes NULL and the rest of the row
survives (PERMISSIVE semantics), without turning ANSI off for the session.

Header names are trimmed so period files that spell a column ``AREA `` and
``AREA`` line up for ``unionByName``. Names bind by each file's own header, never
by position: files are read in groups of equal header lines (``sources.headers``)
and united by name.

``typed_with_rejects`` also accounts for what typing dropped: the names of the
fields whose text has no value, and the text of lines that do not fit the header.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.scalars import parse_money
from .headers import files_by_header, literal

CORRUPT = "_corrupt_record"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim surrounding blanks from column names (``'AREA '`` -> ``'AREA'``)."""
    renames = {c: c.strip() for c in df.columns if c != c.strip()}
    return df.withColumnsRenamed(renames) if renames else df


def read_csv_strings(spark: SparkSession, paths: str | Iterable[str], header: bool = True,
                     schema: T.StructType | None = None, missing: str = "error", corrupt_column: str | None = None,
                     **options: str) -> DataFrame:
    """Read CSV as all-string columns named by each file's header line (trimmed).

    Files with different header lines are read by one scan per header line and
    united by name, so a list of paths (or a folder) equals the union of its
    files read one by one. A column that some files lack is an error, or NULL
    for their rows with ``missing="null"``. ``header=False`` needs ``schema``
    (string fields, bound by position) for header-less files. Paths may be any
    Hadoop-FS URI (``hdfs://``, ``s3a://``). ``corrupt_column`` adds the text of
    lines that have more or fewer fields than the header, NULL for others.
    """
    if missing not in ("error", "null"):
        raise ValueError(f"unknown missing={missing!r}: error or null")
    options = {"header": str(header).lower(), "mode": "PERMISSIVE", **options}
    if corrupt_column:
        # A pruned parse would not see that a line has too many or too few fields.
        options |= {"columnNameOfCorruptRecord": corrupt_column, "columnPruning": "false"}
    plist = [paths] if isinstance(paths, str) else list(paths)

    def strings(names: Iterable[str]) -> T.StructType:
        held = [T.StructField(n, T.StringType(), True) for n in names]
        return T.StructType([*held, T.StructField(corrupt_column, T.StringType(), True)] if corrupt_column else held)

    def scan(files: list[str]) -> DataFrame:
        """Files of one header line."""
        # No inference: every field stays a string until typed_select.
        named = spark.read.options(**options, inferSchema="false").csv(files)
        if corrupt_column:
            named = spark.read.options(**options).schema(strings(named.columns)).csv(files)
        return normalize_columns(named)

    if not header:
        if schema is None:
            raise ValueError("header=False needs a schema to name the columns")
        return normalize_columns(spark.read.options(**options).schema(strings(f.name for f in schema)).csv(plist))
    groups = files_by_header(spark, plist, options.get("comment"))
    if len(groups) < 2:
        return scan(plist)
    frames = [scan([literal(f) for f in group]) for group in groups]
    names = {c.lower(): c for f in reversed(frames) for c in f.columns}
    for group, frame in zip(groups, frames):
        lacking = sorted(set(names) - {c.lower() for c in frame.columns})
        if lacking and missing == "error":
            raise ValueError(f"{group[0]} lacks columns {[names[c] for c in lacking]} of other files; missing='null' fills them")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def typed_column(name: str, data_type: T.DataType, source: Column | None = None,
                 timestamp_pattern: str | None = None, money: bool = False) -> Column:
    """One tolerant typed projection of a text column."""
    c = F.col(f"`{name}`") if source is None else source
    if money:
        out = parse_money(c, data_type.simpleString())
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)) and timestamp_pattern:
        out = F.try_to_timestamp(c, F.lit(timestamp_pattern))
        if isinstance(data_type, T.TimestampNTZType):
            out = out.cast(T.TimestampNTZType())
    elif isinstance(data_type, T.DateType) and timestamp_pattern:
        out = F.try_to_date(c, timestamp_pattern)
    elif isinstance(data_type, T.StringType):
        out = c
    else:
        out = F.trim(c).try_cast(data_type)
    return out.alias(name)


def typed_select(df: DataFrame, schema: T.StructType,
                 timestamp_patterns: Mapping[str, str] | None = None,
                 money_columns: Iterable[str] = ()) -> DataFrame:
    """Project ``df`` to ``schema`` by name in one ``select`` (one Project node).

    Columns of ``schema`` missing from ``df`` are an error; extra columns are
    dropped. Catalyst prunes the scan to the columns a query later uses.
    """
    pats = dict(timestamp_patterns or {})
    money = set(money_columns)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns {missing}; has {df.columns}")
    return df.select([
        typed_column(f.name, f.dataType, timestamp_pattern=pats.get(f.name), money=f.name in money)
        for f in schema
    ])


def typed_with_rejects(df: DataFrame, schema: T.StructType, timestamp_patterns: Mapping[str, str] | None = None,
                       money_columns: Iterable[str] = (), rejects: str = "rejected_fields") -> DataFrame:
    """``typed_select`` plus ``rejects``: the names of the fields that had text but got no value, in schema order.

    Empty text (after trimming) counts as no text. The typed values are computed
    once, in the scan's own stage; other columns of ``df`` (the corrupt line's
    text) are kept. No row is dropped.
    """
    if rejects in df.columns or rejects in schema.names:
        raise ValueError(f"the input has a column {rejects!r}; name another one")
    others = [c for c in df.columns if c not in schema.names]
    typed = typed_select(df, schema, timestamp_patterns, money_columns).columns  # names the missing columns, if any
    pats, money = dict(timestamp_patterns or {}), set(money_columns)
    pairs = df.select(
        *[F.struct(F.col(f"`{f.name}`").alias("text"),
                   typed_column(f.name, f.dataType, timestamp_pattern=pats.get(f.name), money=f.name in money).alias("value")).alias(f.name)
          for f in schema],
        *[F.col(f"`{c}`") for c in others])
    lost = [F.when((F.trim(F.col(f"`{c}`.text")) != "") & F.col(f"`{c}`.value").isNull(), F.lit(c)) for c in typed]
    return pairs.select(*[F.col(f"`{c}`.value").alias(c) for c in typed], F.array_compact(F.array(*lost)).alias(rejects),
                        *[F.col(f"`{c}`") for c in others])


def read_incidents(spark: SparkSession, paths: str | Iterable[str], header: bool = True,
                   columns: Iterable[str] | None = None) -> DataFrame:
    """Typed incident table from one or more period files, whose columns may stand in different orders.

    ``columns`` narrows the result by *name* (the reference bound a five-field
    schema by position, which mislabels columns of a wider file); the scan
    then reads only those columns.
    """
    raw = read_csv_strings(spark, paths, header=header, schema=None if header else schemas.INCIDENT)
    typed = typed_select(raw, schemas.INCIDENT, schemas.TIMESTAMP_PATTERNS)
    return typed.select(*[F.col(f"`{c}`") for c in columns]) if columns is not None else typed


def read_incidents_with_rejects(spark: SparkSession, paths: str | Iterable[str], header: bool = True) -> DataFrame:
    """``read_incidents`` plus ``rejected_fields`` and ``_corrupt_record`` (the text of lines that do not fit the header).

    Rows that pass have an empty array and NULL; ``size(rejected_fields) > 0 OR
    _corrupt_record IS NOT NULL`` selects the others.
    """
    raw = read_csv_strings(spark, paths, header=header, schema=None if header else schemas.INCIDENT, corrupt_column=CORRUPT)
    return typed_with_rejects(raw, schemas.INCIDENT, schemas.TIMESTAMP_PATTERNS)


def read_income(spark: SparkSession, path: str | Iterable[str], header: bool = True) -> DataFrame:
    raw = read_csv_strings(spark, path, header=header, schema=None if header else schemas.INCOME)
    return typed_select(raw, schemas.INCOME, money_columns=schemas.MONEY_COLUMNS)


def read_revgeo(spark: SparkSession, path: str | Iterable[str], header: bool = True) -> DataFrame:
    raw = read_csv_strings(spark, path, header=header, schema=None if header else schemas.REVGEO)
    return typed_select(raw, schemas.REVGEO)


def read_stations(spark: SparkSession, path: str | Iterable[str], header: bool = True) -> DataFrame:
    raw = read_csv_strings(spark, path, header=header, schema=None if header else schemas.STATION)
    return typed_select(raw, schemas.STATION)


def csv_text_roundtrip(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Render each row as CSV text and parse it back through the tolerant typer.

    Exercises the same text -> typed path as a file read (``to_csv`` /
    ``from_csv`` are row-local, so this runs fully distributed and lazily).
    """
    schema = schema or df.schema
    text_ddl = ", ".join(f"`{f.name}` STRING" for f in schema)
    line = F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema]))
    parsed = df.select(F.from_csv(line, F.lit(text_ddl)).alias("r")).select("r.*")
    return typed_select(parsed, schema)


def csv_file_roundtrip(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` as CSV files with a header into ``folder`` and read them back typed.

    The read goes through the same path as the incident files: header names,
    all-string fields, tolerant typed projection. ``folder`` must be shared
    storage on a cluster (the callers use the session's checkpoint folder).
    """
    df.write.mode("overwrite").option("header", "true").csv(folder)
    return typed_select(read_csv_strings(df.sparkSession, folder), df.schema)
