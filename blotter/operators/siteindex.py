"""Candidate cells of a set of sites, written once and found again.

The candidate cells of ``operators.nearest`` depend on the sites and the grid
only, not on the points. An index is a folder named by the sites' fingerprint:

* ``cells/<part>``: candidate cells as Parquet, one part per query that met
  cells which were not there yet;
* ``manifest``: a row per finished part (its name, rows' bytes and the grid
  exponent), appended after the part is written. A part that is not in the
  manifest is never read, so a job lost halfway leaves nothing wrong behind.

A query reads the manifest, takes the cells that are there and builds only what
is missing; the second query on the same sites and area builds nothing. Two
applications that add the same cells at once write the same candidates; cells
are taken once however many parts hold them. Other sites, columns, ``k`` or cell
size give another fingerprint, so an index is never stale and needs no clearing
to stay right.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MANIFEST = "part string, bytes long, exponent int"


def fingerprint_metrics(sites: DataFrame) -> dict[str, Column]:
    """Two sums of row hashes, which don't depend on the rows' order."""
    columns = [F.col(f"`{c}`") for c in sites.columns]
    number = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)")).cast("string")
    return {"told": number(*columns), "told_again": number(F.lit("again"), *columns)}


def fingerprint_of(sites: DataFrame, seen: dict, k: int, cell_deg: float | None) -> str:
    """Names the sites' rows and columns (from the observed ``fingerprint_metrics``), ``k`` and the cell size asked for."""
    what = [seen["rows"], seen["told"], seen["told_again"], sites.schema.simpleString(), k, cell_deg]
    return hashlib.sha256(json.dumps(what).encode()).hexdigest()[:32]


@dataclass
class SiteIndex:
    spark: SparkSession
    folder: str
    parts: list[str]
    size: int
    exponent: int | None

    @classmethod
    def at(cls, spark: SparkSession, fingerprint: str, root: str | None = None) -> SiteIndex:
        """The index of that fingerprint in ``root`` (default: the application's checkpoint folder); empty if there is none."""
        root = (root or ensure_checkpoint_dir(spark)).rstrip("/")
        out = cls(spark, f"{root}/site-index/{fingerprint}", [], 0, None)
        out._look()
        return out

    def _look(self) -> None:
        manifest = f"{self.folder}/manifest"
        self.spark.createDataFrame([], MANIFEST).coalesce(1).write.mode("ignore").parquet(manifest)  # only if there is none
        rows = self.spark.read.schema(MANIFEST).parquet(manifest).collect()  # a row per part
        self.parts = sorted(r["part"] for r in rows)
        self.size = sum(r["bytes"] for r in rows)
        self.exponent = min((r["exponent"] for r in rows), default=None)

    def cells(self) -> tuple[DataFrame | None, int]:
        """The candidate cells (None if there are none) and at most how many bytes they have."""
        if not self.parts:
            return None, 0
        held = self.spark.read.parquet(*[f"{self.folder}/cells/{p}" for p in self.parts])
        if len(self.parts) > 1:
            held = held.groupBy("__x0", "__y0").agg(F.first("__cands").alias("__cands"))
        return held, self.size

    def add(self, cells: DataFrame, size: int, exponent: int) -> None:
        """Write ``cells`` as a new part, then name it in the manifest."""
        part = uuid.uuid4().hex
        cells.write.parquet(f"{self.folder}/cells/{part}")
        told = self.spark.createDataFrame([(part, size, exponent)], MANIFEST)
        told.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        self._look()
