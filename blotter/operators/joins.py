"""Joins with a selectable physical strategy, and dimension-restricted facts.

The reference compares physical strategies on the same query. Here a strategy
is a Spark join hint placed on the *build* side (the right argument by
convention). A named strategy is done as named or raises; none is swapped for
another by size:

* ``broadcast`` writes the build side once into the checkpoint folder and
  measures its bytes there; above ``max_broadcast_bytes`` it raises.
* ``merge`` / ``shuffle_hash`` shuffle both sides on the key; AQE's skew-join
  handling splits a hot key's partition on the streamed side.
* ``bloom`` (restrictions only) tests a Bloom filter of the keys in the fact
  scan's stage, then merges (``operators.bloom``): for key sets too big to
  broadcast.
* ``salted`` (equi-joins by column names) spreads heavy hitters over many tasks
  before a merge join (``operators.skew``), whatever AQE is set to.
* ``auto`` carries no hint: AQE re-plans from the *measured* size of the
  shuffled build side.

The nested loop, which evaluates every pair, is not offered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, materialize_counted
from .bloom import bloom_filtered
from .skew import salted_join

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")
RESTRICTING = (*STRATEGIES, "bloom")

DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 ** 2


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: text and binary by their length, nested values by their JSON text, 16 per column besides."""
    total = F.lit(16)
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        total = total + 16
    return total.cast("bigint")


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written once into the checkpoint folder, and its bytes, gathered by the same job."""
    out, seen = materialize_counted(df, bytes=F.sum(row_bytes(df)))
    return out, int(seen["bytes"] or 0)


def broadcast_side(df: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` hinted for broadcast, once its measured bytes are within the bound; else an error."""
    out, size = measured(df)
    if size > max_broadcast_bytes:
        raise ValueError(f"the build side has {size} bytes, above the {max_broadcast_bytes} that may be broadcast")
    return F.broadcast(out)


def hinted(df: DataFrame, strategy: str, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` as the build side of ``strategy``."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose from {STRATEGIES}")
    if strategy == "broadcast":
        return broadcast_side(df, max_broadcast_bytes)
    return df if strategy == "auto" else df.hint(strategy)


def join_with_strategy(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column,
                       how: str = "inner", strategy: str = "auto",
                       max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``left.join(right, on, how)`` with ``right`` as the hinted build side."""
    if strategy == "salted":
        if isinstance(on, Column):
            raise ValueError("a salted join needs column names that both sides have")
        names = [on] if isinstance(on, str) else list(on)
        renamed = right.withColumnsRenamed({c: f"__right_{c}" for c in names})
        joined = salted_join(left, renamed, [left[f"`{c}`"] for c in names], [renamed[f"`__right_{c}`"] for c in names], how)
        return joined.drop(*[f"__right_{c}" for c in names])
    return left.join(hinted(right, strategy, max_broadcast_bytes), on, how)


def restrict_by_dimension(facts: DataFrame, lookup: DataFrame, dims: DataFrame,
                          lookup_dim_key: str, dim_key: str, fact_keys: Sequence[str],
                          strategy: str = "auto",
                          max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Facts whose ``fact_keys`` appear in ``lookup`` rows that point at ``dims``.

    Three steps: ``lookup`` joined to the selected ``dims`` (inner, on
    ``lookup_dim_key == dim_key``) -> distinct ``fact_keys`` -> facts restricted
    to those keys. Because the keys are distinct, the last step is a semi join
    (rows of ``facts`` are never duplicated).

    The restricted key set is checkpointed, so a lost executor does not
    recompute it. ``bloom`` also drops facts that certainly have no key before
    they are shuffled; its steps before that join by merge.
    """
    dim_keys = dims.select(F.col(dim_key).alias("__dim_key")).distinct()
    if strategy not in RESTRICTING:
        raise ValueError(f"unknown strategy {strategy!r}; choose from {RESTRICTING}")
    joined = join_with_strategy(lookup, dim_keys, F.col(lookup_dim_key) == F.col("__dim_key"),
                                "inner", "merge" if strategy == "bloom" else strategy, max_broadcast_bytes)
    keys = joined.select(*fact_keys).distinct()
    if strategy == "bloom":
        keys, seen = materialize_counted(keys)
        facts = bloom_filtered(facts, keys, list(fact_keys), seen["rows"])
        return join_with_strategy(facts, keys, list(fact_keys), "left_semi", "merge")
    if strategy != "broadcast":  # a broadcast side is written by its size check
        keys = materialize(keys)
    return join_with_strategy(facts, keys, list(fact_keys), "left_semi", strategy, max_broadcast_bytes)
