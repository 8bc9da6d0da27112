"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import ensure_checkpoint_dir

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of whole texts that go to a Python worker at once; the default of 10,000 is meant for short rows.
MOST_ROWS = 2048
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application, and bound the batches they get."""
    if int(spark.conf.get(ARROW_ROWS)) > MOST_ROWS:
        spark.conf.set(ARROW_ROWS, MOST_ROWS)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="blotter-src-")) / "blotter_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_for(amount: float, per_partition: float, spark: SparkSession) -> int:
    """Partitions so that each holds about ``per_partition``; never below the session's shuffle setting."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(amount // per_partition) + 1)


def hash_unit(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of MD5 over the parts; the same in any SQL engine that has MD5."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def fresh(columns: list[str], stem: str) -> str:
    """A name that is in none of the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
