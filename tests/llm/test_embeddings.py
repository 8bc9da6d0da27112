from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import embeddings, graph
from tests.conftest import SF_SMALL


def brute(rows, threshold):
    """rows: (vec_id, embedding, label)."""

    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])

    n = len(rows)
    links, root = [0] * n, list(range(n))
    good = [i for i in range(n) if usable(rows[i])]
    for a, i in enumerate(good):
        x = np.array(rows[i][1], dtype=float)
        for j in good[a + 1 :]:
            y = np.array(rows[j][1], dtype=float)
            if rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = root[i], root[j]
                root = [min(p, q) if r in (p, q) else r for r in root]
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i]]
        own = None if rows[i][0] is None else min(ids)
        out.append((rows[i][0], links[i], own, rows[i][0] is not None and rows[i][0] == own))
    return sorted(out, key=str)


def run(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    return sorted(map(tuple, embeddings.near_duplicates(df, **sizes).collect()), key=str)


def planted(seed=1, n=240, size=24):
    r = np.random.default_rng(seed)
    rows, base = [], r.normal(size=(12, size))
    for i in range(n):
        x = base[r.integers(12)] + r.normal(size=size) * r.choice([0.0, 0.1, 0.28, 0.6])
        rows.append((i, [float(v) for v in x.astype(np.float32)], int(r.integers(3))))
    return rows


@pytest.mark.parametrize("tile_rows", [2048, 30])
def test_equal_brute_force(spark, tile_rows):
    rows = planted()
    assert run(spark, rows, tile_rows=tile_rows) == brute(rows, 0.93)


def test_odd_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(5, one, 1), (3, one, 1), (3, one, 1), (4, [2.0, 0.0, 0.0], 1), (6, one, None), (7, None, 1), (8, [0.0, 0.0, 0.0], 1), (9, [], 1),
            (10, [1.0, None, 0.0], 1), (11, [float("nan"), 1.0, 0.0], 1), (12, [float("inf"), 1.0, 0.0], 1), (13, [1.0, 0.0], 1), (None, one, 1), (14, one, 2)]
    assert run(spark, rows) == brute(rows, 0.93)
    assert run(spark, []) == []


def test_pruning_keeps_all_and_drops_most():
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 64)) * (np.arange(64) < 6) + r.normal(size=(300, 64)) * 0.05
    rotation = embeddings.axes(embeddings.unit(x).T @ embeddings.unit(x))
    got = {(i, j) for a, b in embeddings.linked_pairs(x, x, rotation, 0.9, True) for i, j in zip(a, b)}
    u = embeddings.unit(x)
    assert got == {(i, j) for i, j in zip(*np.nonzero(np.triu(u @ u.T >= 0.9, 1)))}


def test_generated_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in df.collect()]
    assert sorted(map(tuple, embeddings.near_duplicates(df, tile_rows=20).collect()), key=str) == brute(rows, 0.93)


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(1000, 1100)]
    star = [(5, i) for i in range(2000, 2300)]
    df = spark.createDataFrame(path + star + [(7, 7), (3001, 3000)], "a long, b long")
    got = {r["id"]: r["component_id"] for r in graph.components(df).collect()}
    assert got == {i: 1000 for i in range(1000, 1101)} | {5: 5} | {i: 5 for i in range(2000, 2300)} | {3000: 3000, 3001: 3000}
    assert graph.components(df.filter(F.lit(False))).count() == 0
