"""Connected components by alternating large and small stars; edges and labels stay distributed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize


def smallest_reachable(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Per index, the smallest index reachable by the pairs; within one task."""
    label = np.arange(n)
    while True:
        before = label.copy()
        for i, j in pairs:
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _smallest(pairs: DataFrame) -> DataFrame:
    """(v, m): the smallest of v and its neighbours u; combined before the shuffle."""
    return pairs.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("m"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """id, component_id (the smallest id reachable) for every end of the edges (a, b), which are longs.

    Each round hangs all larger neighbours of a vertex on its smallest one, then all smaller ones; the number of rounds
    grows with the logarithm of a component's diameter. A vertex with very many neighbours is a skewed join key only, which
    adaptive execution splits. Null ends and loops are ignored.
    """
    held = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    before = None
    for _ in range(most_rounds):
        both = held.unionByName(held.select(F.col("u").alias("v"), F.col("v").alias("u")))
        large = both.join(_smallest(both), "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.filter("v <> u").distinct()
        low = _smallest(large)
        small = large.join(low, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        held = materialize(small.unionByName(low.select("v", F.col("m").alias("u"))).distinct())
        state = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components didn't settle")
    roots = held.select(F.col("u").alias("id")).distinct()
    return held.select(F.col("v").alias("id"), F.col("u").alias("component_id")).unionByName(roots.withColumn("component_id", F.col("id")))
