"""Mixing sources to target weights (operator 10) by Poisson replication, in DataFrame functions only.

A source with weight w should give ``w / sum of weights`` of the output, which has as many documents as the input (or
``size``). Its mean repetition rate is its target count over its document count. Each document draws a uniform number
from a hash of the seed and its id, and the Poisson distribution's inverse at that number is its count of
copies, so a draw doesn't depend on partitioning, order or retries. Copies get a hash key each; dealing by that key and
sorting each partition by it shuffles globally.

Rates need one count per listed source (no join: the inverse's steps travel as literals of the plan). Nulls, ties and
odd rows: a source that isn't listed, the null source included, keeps ``default_rate``; a weight of 0 drops a source; a
listed source without documents is ignored and the others share its part; repeated rows draw alike, and each is
repeated; other columns pass through; columns named ``copy`` or ``shuffle_key`` are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import fresh, hash_unit


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """The distribution function from the first count a draw can reach to the last; the counts left out before it."""
    first = max(0, math.floor(rate - 12 * math.sqrt(rate) - 12))
    last = math.ceil(rate + 12 * math.sqrt(rate) + 24)
    steps, total = [], 0.0
    for k in range(first, last + 1):
        total = min(1.0, total + (math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate > 0 else float(k == 0)))
        steps.append(total)
        if total == 1.0:
            break
    return first, steps


def repetition_rates(docs: DataFrame, weights: Mapping[str, float], size: int | None = None) -> dict[str, float]:
    listed = docs.filter(F.col("source").isin(list(weights))).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["source"]: r["n"] for r in listed.collect()}  # at most one row per listed source
    shares = {s: w for s, w in weights.items() if counts.get(s)}
    goal, total = sum(counts.values()) if size is None else size, sum(shares.values())
    return {s: goal * w / total / counts[s] if total else 0.0 for s, w in shares.items()}


def copies(draw: Column, rates: Mapping[str, float], default_rate: float) -> Column:
    def inverse(rate: float) -> Column:
        first, steps = poisson_steps(rate)
        return F.size(F.filter(F.array(*[F.lit(x) for x in steps]), lambda x: x <= draw)) + first

    out = inverse(default_rate)
    for source, rate in rates.items():
        out = F.when(F.col("source") == source, inverse(rate)).otherwise(out)
    return out


def mix(
    docs: DataFrame, weights: Mapping[str, float], seed: int = 0, default_rate: float = 1.0, size: int | None = None,
    copy: str = "copy", shuffle_key: str = "shuffle_key",
) -> DataFrame:
    """The documents' columns with ``copy`` (from 0) and ``shuffle_key``, in shuffled order.

    Columns of the documents that have one of these two names are replaced.
    """
    rates = repetition_rates(docs, weights, size)
    held = [c for c in docs.columns if c not in (copy, shuffle_key)]
    drawn, times = fresh(held, "draw"), fresh(held, "times")
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), identity, F.col(copy).cast("string")))
    return (
        docs.select(*held)
        .withColumn(drawn, hash_unit(F.lit(seed), identity))
        .withColumn(times, copies(F.col(drawn), rates, default_rate))
        .filter(F.col(times) > 0)
        .select(*held, F.explode(F.sequence(F.lit(0), F.col(times) - 1)).alias(copy))
        .withColumn(shuffle_key, key)
        .repartition(shuffle_key)
        .sortWithinPartitions(shuffle_key)
    )
