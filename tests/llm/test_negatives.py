from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import negatives as N
from blotter.llm import queries
from tests.conftest import SF_SMALL


def brute(rows, anchor, positives=5, negatives=10, low=30, high=90, label=lambda r: r[2]):
    """rows: (vec_id, embedding, label)."""
    held = {}
    for r in rows:
        if r[0] is not None and label(r) is not None and r[1] and all(v is not None and math.isfinite(v) for v in r[1]):
            own = (label(r), [math.floor(256 * v) for v in r[1]])
            held[r[0]] = min(held.get(r[0], own), own)
    out = []
    for a, (la, x) in held.items():
        if not anchor(a):
            continue
        scores = [(-sum(p * q for p, q in zip(x, y)), b, lb == la) for b, (lb, y) in held.items() if b != a and len(x) == len(y)]
        scores.sort()
        for s, b, _ in [t for t in scores if t[2]][:positives]:
            fit = [t for t in scores if not t[2] and low * -s <= 100 * -t[0] <= high * -s][:negatives]
            out += [(a, b, k + 1, t[1], -s, -t[0]) for k, t in enumerate(fit)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, rank int, score int")
    return sorted(map(tuple, N.mine(df, **more).collect()))


def planted(seed=1, n=240, size=20, classes=3, spread=0.5):
    r = np.random.default_rng(seed)
    base = r.normal(size=(8, size))
    rows = []
    for i in range(n):
        x = (base[r.integers(8)] + r.normal(size=size) * spread).astype(np.float32)
        rows.append((i, [float(v) for v in x], int(r.integers(classes))))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 7, "group_rows": 20}])
def test_equal_brute_force(spark, sizes):
    rows = planted()
    got = run(spark, rows, is_anchor=F.col("vec_id") % 10 == 0, **sizes)
    assert got == brute(rows, lambda i: i % 10 == 0) and got


def test_ties(spark):
    """Few different vectors: nearly all scores tie, so ids decide."""
    r = np.random.default_rng(4)
    base = r.integers(-2, 3, (5, 6)) / 2
    rows = [(i, [float(v) for v in base[r.integers(5)]], int(r.integers(2))) for i in range(150)]
    assert run(spark, rows, is_anchor=F.col("vec_id") % 15 == 0, group_rows=40) == brute(rows, lambda i: i % 15 == 0)


def test_every_row_an_anchor_and_other_bounds(spark):
    rows = planted(5, 60, 9)
    assert run(spark, rows, positives=2, negatives=3, low=10, high=100) == brute(rows, lambda i: True, 2, 3, 10, 100)


def test_odd_rows(spark):
    one = [1.0, 0.5, 0.0]
    rows = [(0, one, 1), (3, one, 1), (3, one, 1), (3, [0.5, 0.5, 0.5], 0), (4, [0.9, 0.4, 0.1], 2), (5, [0.6, 0.2, 0.1], 2), (6, one, None), (7, None, 1),
            (8, [0.0, 0.0, 0.0], 1), (9, [], 1), (10, [1.0, None, 0.0], 1), (11, [float("nan"), 1.0, 0.0], 1), (12, [float("inf"), 1.0, 0.0], 1),
            (13, [1.0, 0.0], 1), (14, [0.5, 0.5], 2), (None, one, 2), (15, [-1.0, -0.5, 0.0], 1), (16, [0.7, 0.1, 0.0], 3), (-2, [0.8, 0.4, 0.0], 2)]
    assert run(spark, rows) == brute(rows, lambda i: True)
    assert run(spark, []) == []
    assert run(spark, [(1, one, 1)]) == []
    assert run(spark, [(1, one, None), (2, None, None)]) == []
    assert run(spark, rows, is_anchor=F.lit(None).cast("boolean")) == []


def test_a_vector_that_a_third_share(spark):
    rows = planted(6, 200, 12) + [(1000 + i, [0.25] * 12, 1) for i in range(100)]
    assert run(spark, rows, is_anchor=F.col("vec_id") % 50 == 0, group_rows=64) == brute(rows, lambda i: i % 50 == 0)


def test_large_components(spark):
    rows = [(i, [v * 30000.0 for v in x], c) for i, x, c in planted(7, 40, 6, spread=0.2)]
    rows = [(i, [float(np.float32(max(-60000.0, min(60000.0, v)))) for v in x], c) for i, x, c in rows]
    assert run(spark, rows) == brute(rows, lambda i: True)
    with pytest.raises(Exception, match="scale the vectors"):
        run(spark, [(1, [1e30], 1), (2, [1.0], 1)])


def test_strip_finds_all_and_skips_much():
    """All pairs that reach a threshold are found; of the others, few are scored in full, and low-energy dimensions are left out."""
    r = np.random.default_rng(8)
    y = (r.normal(size=(600, 48)) * 300 * (0.8 ** np.arange(48))).astype(np.int64)
    x, none = y[:20] + r.integers(-5, 6, (20, 48)), np.zeros((20, 600), bool)
    full = x @ y.T
    strip = N.Strip(x, y, none)
    for share in (0.9, 0.6, 0.3):
        threshold = np.quantile(full, share, axis=1)
        before = strip.decided.copy()
        i, j, score = strip.join(np.ones(20, bool), threshold)
        assert (score == full[i, j]).all() and not before[i, j].any()
        assert ((full < threshold[:, None]) | strip.decided).all()
        if share == 0.9:
            assert strip.decided.mean() < 0.2
            assert strip.done.mean() < len(strip.bounds) - 1


def test_search_equals_sorting(monkeypatch):
    r = np.random.default_rng(9)
    for strip in (4096, 33):
        monkeypatch.setattr(N, "STRIP", strip)
        x, y = r.integers(-90, 90, (9, 10)), r.integers(-90, 90, (300, 10))
        ids, anchor_of = r.permutation(300), np.repeat(np.arange(9), 3)
        full = x @ y.T
        low = r.integers(-20000, 30000, 27)
        high = low + r.integers(0, 30000, 27)
        best = N.Best(low, high, 6)
        N.search(x, y, ids, lambda s: np.zeros((9, len(ids[s])), bool), best, anchor_of)
        for w in range(27):
            want = sorted((-s, i) for s, i in zip(full[anchor_of[w]], ids) if low[w] <= s <= high[w])[:6]
            assert [(-s, i) for s, i in zip(best.score[best.window == w], best.id[best.window == w])] == want


def test_generated_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in table.collect()]
    want = brute(rows, lambda i: i % 100 == 0, label=lambda r: r[2] if r[2] is None or r[0] % 7 else (r[2] + 1) % 10)
    assert sorted(map(tuple, queries.op12_hard_negatives(spark, SF_SMALL).collect())) == want
