"""Tables laid out by a key, so that joins and ranks on it need no exchange.

A bucketed table holds each key's rows in one of a fixed number of buckets,
sorted by the key. Two tables bucketed alike on their join keys are merged
bucket by bucket, and a rank or aggregate per key reads its groups where they
lie. Writing the layout costs one shuffle, once; every later query on the key
saves one.

A bucket is read by one task, so lay a table out by a key whose rows are even
enough (an incident number, not a premise); ``operators.skew`` serves the
others. The files go to a shared folder (by default the checkpoint folder); the
catalog entry that Spark needs to know the buckets is dropped again, the files
stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int, folder: str | None = None) -> DataFrame:
    """``df`` written as a table of ``buckets`` buckets by ``keys``, and read from it.

    Tables meet without an exchange if their keys have equal types and their
    number of buckets is the same. Rows with NULL keys are kept.
    """
    spark = df.sparkSession
    name = f"blotter_bucketed_{uuid.uuid4().hex}"
    path = f"{(folder or ensure_checkpoint_dir(spark)).rstrip('/')}/{name}"
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])  # one file per bucket
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # an external one: its files stay
