"""Embedding near-dedup (operator 9): PCA-ordered tiled comparison.

Vectors are compared only within a label, by cosine in double precision. Equal vectors of a label are first merged into
one with a weight (combined before the shuffle), so a vector that a third of all rows share costs what one costs. A
rotation to the principal axes puts the dimensions that tell most in front. Rows of a label are dealt to tiles, and each
pair of tiles is a task of bounded size: products accumulate over the leading dimensions, the rest is bounded by the
product of the rows' suffix norms (Cauchy-Schwarz), and a pair is dropped as soon as the sum can't reach the threshold.
Pairs that survive all dimensions are decided by the cosine of the vectors as given. A task returns the weighted link
count of its rows and at most one edge per row (to the smallest id in its part of the graph), never the pairs.

Vectors that are null, empty, zero or hold null or non-finite numbers, and those with a null label or null vec_id, link
with nothing (component_id is their own id, kept is true; with a null id component_id is null and kept false). Vectors
of different lengths don't link. Repeated rows are vectors of their own; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize, ship
from blotter.llm.graph import components, smallest_reachable

MARGIN = 1e-6  # for rounding in the rotated products; the decision itself is by the given vectors


def covariances(classes: DataFrame) -> dict[int, np.ndarray]:
    """Sum of outer products of the unit vectors, per vector length; tasks send one matrix per length."""

    def run(frames):
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for size, own in frame.groupby("size")["embedding"]:
                x = unit(np.stack(own.to_numpy()).astype(np.float64))
                sums[size] = sums.get(size, 0) + x.T @ x
        for size, total in sums.items():
            yield pd.DataFrame({"size": size, "at": np.arange(size * size), "part": total.ravel()})

    rows = classes.select("size", "embedding").mapInPandas(run, "size int, at int, part double").groupBy("size", "at").agg(F.sum("part").alias("x"))
    out: dict[int, np.ndarray] = {}
    for r in rows.collect():  # the square of the vector length
        out.setdefault(r["size"], np.zeros(r["size"] ** 2))[r["at"]] = r["x"]
    return {size: m.reshape(size, size) for size, m in out.items()}


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def axes(covariance: np.ndarray) -> np.ndarray:
    """Principal axes as columns, by falling variance."""
    return np.linalg.eigh(covariance)[1][:, ::-1]


def linked_pairs(x: np.ndarray, y: np.ndarray, rotation: np.ndarray, threshold: float, same: bool, steps=(8, 16, 32), strip: int = 256):
    """Index pairs (i of x, j of y; i < j if same) with cosine >= threshold, strip by strip."""
    px, py, size = unit(x) @ rotation, unit(y) @ rotation, x.shape[1]
    bounds = [s for s in steps if s < size] + [size]
    suffix = lambda p, at: np.sqrt(np.maximum(0.0, (p[:, at:] ** 2).sum(axis=1)))
    rest_x, rest_y = [suffix(px, b) for b in bounds], [suffix(py, b) for b in bounds]
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    for a in range(0, len(x), strip):
        own = slice(a, a + strip)
        products = px[own, : bounds[0]] @ py[:, : bounds[0]].T
        alive = products + np.outer(rest_x[0][own], rest_y[0]) >= threshold - MARGIN
        if same:
            alive &= np.arange(a, a + len(alive))[:, None] < np.arange(len(y))
        k = 0
        while k + 1 < len(bounds) and alive.mean() > 0.1:  # many left: whole strips cost less than single pairs
            products += px[own, bounds[k] : bounds[k + 1]] @ py[:, bounds[k] : bounds[k + 1]].T
            k += 1
            alive &= products + np.outer(rest_x[k][own], rest_y[k]) >= threshold - MARGIN
        i, j = np.nonzero(alive)
        total = products[i, j]
        i += a
        while k + 1 < len(bounds) and len(i):
            total = total + np.einsum("ij,ij->i", px[i, bounds[k] : bounds[k + 1]], py[j, bounds[k] : bounds[k + 1]])
            k += 1
            left = total + rest_x[k][i] * rest_y[k][j] >= threshold - MARGIN
            i, j, total = i[left], j[left], total[left]
        cosine = np.concatenate(
            [np.einsum("ij,ij->i", x[i[c : c + 4096]], y[j[c : c + 4096]]) for c in range(0, len(i), 4096)] or [np.empty(0)]
        ) / (nx[i] * ny[j])
        hit = cosine >= threshold
        yield i[hit], j[hit]


def compare_tiles(classes: DataFrame, rotations: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """id, links (weighted, within one pair of tiles), root (smallest linked id there)."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        first, second = key[2], key[3]
        frame = frame.sort_values("id", ignore_index=True)
        x = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
        ids, weights, tiles = frame["id"].to_numpy(), frame["weight"].to_numpy(), frame["tile"].to_numpy()
        left, right = np.flatnonzero(tiles == first), np.flatnonzero(tiles == second)
        links, pairs = np.zeros(len(frame), np.int64), []
        if len(left) and len(right):
            for i, j in linked_pairs(x[left], x[right], rotations[int(key[1])], threshold, bool(first == second)):
                i, j = left[i], right[j]
                np.add.at(links, i, weights[j])
                np.add.at(links, j, weights[i])
                pairs.append((i, j))
        root = smallest_reachable(len(frame), pairs)
        out = pd.DataFrame({"id": ids, "links": links, "root": ids[root]})
        return out[links > 0]

    return classes.groupBy("label", "size", "first", "second").applyInPandas(run, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile_rows: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    ship(spark)
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = F.forall("embedding", lambda v: v == 0)
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & (F.size("embedding") > 0) & ~bad & ~zero
    )
    told = F.sha2(F.array_join(F.transform("embedding", lambda v: v.cast("string")), ","), 256)
    rows = vectors.select(F.col("vec_id").cast("long"), "label", "embedding").withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.filter("usable").withColumn("told", told)
    classes = materialize(
        good.groupBy("label", "told").agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("embedding").alias("embedding")
        ).withColumn("size", F.size("embedding"))
    )
    rotations = {size: axes(c) for size, c in covariances(classes).items()}
    tiles = classes.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    dealt = (
        classes.join(tiles, ["label", "size"])
        .withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("label", "size", "id", "weight", "embedding", "tile",
                F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"))
    )
    found = materialize(compare_tiles(dealt, rotations, threshold))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    told_of = (
        classes.select("label", "told", "id", "weight")
        .join(links, "id", "left")
        .join(roots, "id", "left")
        .select("label", "told", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    )
    linked = good.select("vec_id", "label", "told").join(told_of, ["label", "told"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
