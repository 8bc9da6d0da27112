from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from blotter.llm import codes, queries
from tests.conftest import SF_SMALL


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, embedding, label)."""
    kept = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(v is not None and math.isfinite(v) for v in r[1])]
    kept = [(i, [math.floor(256 * v) for v in x], c) for i, x, c in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, len(r[1]), r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda x, p: x[p * width : (p + 1) * width]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = {}
            for r in kept:
                own.setdefault(nearest(p, cut(r[1], p))[1], []).append(cut(r[1], p))
            new.append([[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])])
        books = new
    told = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    found = [[nearest(p, cut(r[1], p)) for p in range(parts)] for r in kept]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = {}
    for r, e in zip(kept, errors):
        of_label[r[2]] = of_label.get(r[2], 0) + e
    out = [(r[0], "".join(f"{k:02x}" for _, k in f), e, of_label[r[2]], told) for r, f, e in zip(kept, found, errors)]
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, numbers int")
    return sorted(map(tuple, codes.compress(df, **more).collect()), key=str)


def planted(seed=1, n=200, size=32):
    r = np.random.default_rng(seed)
    return [(int(i), [float(v) for v in r.normal(size=size).astype(np.float32) * 0.4], int(r.integers(4)) if r.random() < 0.9 else None)
            for i in r.permutation(n)]


def test_equal_brute_force(spark):
    rows = planted()
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, parts=4, entries=7, rounds=3) == brute(rows, 4, 7, 3)


def test_odd_rows(spark):
    good = planted(2, 30)
    odd = [(3, good[0][1], 1), (3, good[0][1], 1), (None, good[1][1], None), (90, None, 1), (91, [], 1), (92, [1.0] * 31, 1), (93, [1.0] * 48, 1),
           (94, [None] + [1.0] * 31, 1), (95, [float("nan")] * 32, 1), (96, [float("-inf")] * 32, 1), (97, [0.0] * 32, None), (98, [-0.001] * 32, 2)]
    assert run(spark, good + odd) == brute(good + odd)
    assert run(spark, []) == [] and run(spark, [(1, None, 1)]) == []
    assert run(spark, good[:1]) == brute(good[:1])
    assert run(spark, [(None, good[0][1], 1), (None, good[1][1], 1)]) == brute([(None, good[0][1], 1), (None, good[1][1], 1)])
    with pytest.raises(Exception, match="scale the vectors"):
        run(spark, [(1, [1e30] * 16, 1)])
    with pytest.raises(ValueError):
        run(spark, good, entries=257)


def test_a_vector_and_a_label_that_most_share(spark):
    rows = planted(3, 40) + [(100 + i, [0.25] * 32, 1) for i in range(200)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("shape", [(3000, 64, 2, 4), (500, 1, 3, 5), (2000, 256, 4, 40), (3000, 64, 4, 3), (4000, 64, 4, 300)])
def test_orchard_search_equals_all_distances(shape):
    """Ties by the lower index, equal entries, few and many entries."""
    n, k, width, span = shape
    r = np.random.default_rng(n)
    entries, x = r.integers(-span, span, (k, width)), r.integers(-span, span, (n, width))
    best, distance = codes.Codebook(entries).nearest(x)
    apart = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_orchard_search_measures_few_entries(monkeypatch):
    r = np.random.default_rng(5)
    entries = r.integers(-2000, 2000, (64, 4))
    x = entries[r.integers(64, size=2000)] + r.integers(-20, 20, (2000, 4))
    book, measured = codes.Codebook(entries), []
    lists = book.lists

    class Counted:
        def __getitem__(self, at):
            measured.append(len(at[0]))
            return lists[at]

    book.lists = Counted()
    best, _ = book.nearest(x)
    assert (best == ((x[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(measured) < 0.8 * 64 * len(x)


def test_generated_table(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op13_vector_codes(spark, SF_SMALL).collect()), key=str) == brute(rows)
