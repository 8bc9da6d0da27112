"""Equi-join with heavy hitters spread over many tasks.

A merge join sends all rows of a key to one task; AQE can split such a task
only where its settings say so and neither side needs its ordering. Here the
hot keys are found first (``approx_top_k``, one pass over the key column) and
salted: their rows on the left are dealt to as many salts as the key has shares
of an average task, and the right side's rows of that key are replicated to each
salt. All other keys have the one salt 0 and are joined plainly.

The salt of a row is a hash of its columns: a task that runs again deals its
rows the same way. Estimated counts decide only how rows are spread, never
which rows join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Only left rows are dealt, so a right row must not be kept for want of a match in one salt.
KINDS = ("inner", "left", "left_semi", "left_anti")
MAX_HOT_KEYS = 4096


def hot_keys(df: DataFrame, keys: Sequence[Column], tasks: int) -> list[tuple[int, int]]:
    """(hash of the key, salts) of keys with more rows than one of ``tasks`` should have; at most ``tasks`` of them."""
    k = max(1, min(tasks, MAX_HOT_KEYS))
    some = reduce(Column.__and__, [c.isNotNull() for c in keys])
    named = df.filter(some).select(F.xxhash64(*keys).alias("h"))
    seen = named.agg(F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k", F.col("h"), F.lit(k), F.lit(max(1000, 10 * k))).alias("top")).first()
    share = -(-(seen["n"] or 0) // tasks)
    return [(x["item"], -(-x["count"] // share)) for x in seen["top"] or [] if x["count"] > share]


def salted_join(left: DataFrame, right: DataFrame, left_keys: Sequence[Column], right_keys: Sequence[Column], how: str = "inner",
                tasks: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` where the keys are equal, by merge join, hot keys of ``left`` spread over many tasks.

    Keys are paired in order and must have equal types. The result has all
    columns of both sides (of the left one for a semi or anti join).
    ``tasks`` (default: the session's shuffle partitions) says how many tasks
    share the rows. Right rows of hot keys are written once per salt, at most
    two rows per task beyond what they are.
    """
    if how not in KINDS:
        raise ValueError(f"a salted join can be one of {KINDS}, not {how!r}")
    spark = left.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, left_keys, tasks)
    lk, rk = ([f"__{side}{i}" for i in range(len(left_keys))] for side in "lr")
    lefts = left.withColumns(dict(zip(lk, left_keys)))
    rights = right.withColumns(dict(zip(rk, right_keys)))
    # At most ``tasks`` rows: small enough to send with the code.
    salts = spark.createDataFrame(hot, "__h long, __salts long")
    lefts = (lefts.join(F.broadcast(salts), F.xxhash64(*lk) == F.col("__h"), "left")
             .withColumn("__lsalt", F.when(F.col("__salts").isNull(), F.lit(0)).otherwise(
                 F.pmod(F.xxhash64(F.lit("salt"), *[F.col(f"`{c}`") for c in left.columns]), F.col("__salts")))))
    rights = (rights.join(F.broadcast(salts), F.xxhash64(*rk) == F.col("__h"), "left")
              .withColumn("__rsalt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__salts"), F.lit(1)) - 1))))
    rights = rights.drop("__h", "__salts").hint("merge")
    on = F.col("__lsalt") == F.col("__rsalt")
    for a, b in zip(lk, rk):
        on = on & (F.col(a) == F.col(b))
    return lefts.drop("__h", "__salts").join(rights, on, how).drop(*lk, *rk, "__lsalt", "__rsalt")
