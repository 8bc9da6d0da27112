from __future__ import annotations

import random
import re

import numpy as np
import pytest

from blotter.llm import cells, jaccard
from tests.conftest import SF_SMALL


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j] and 100 * common >= 75 * len(sets[i] | sets[j]):
                p, q = root[i], root[j]
                root = [min(p, q) if r in (p, q) else r for r in root]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        own = None if doc_id is None else min(rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None)
        out.append((doc_id, len(sets[i]), own))
    return sorted(out, key=str)


def test_tiles_decide_very_long_sets_exactly():
    common = 671_097  # 100 times this is no float32
    for size, linked in ((common // 3 * 4, True), (common // 3 * 4 + 1, False)):
        sets = [np.arange(common, dtype=np.uint64), np.arange(size, dtype=np.uint64)]
        told = jaccard.similar_pairs(sets, np.array([common, size]), np.array([0]), np.array([1]), 75)
        assert len(told[0]) == linked


def run(spark, rows, parts=3, **sizes):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n long, digest string").repartition(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return sorted(map(tuple, jaccard.similar_documents(df, **sizes).collect()), key=str)


def near_copies(seed=1, groups=10, singles=40):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = r.choices(vocabulary, k=60)
    rows = []
    for g in range(groups):
        base = r.choices(vocabulary, k=r.choice([4, 6, 30, 90, 250]))
        if g % 3 == 0:
            base = base + passage
        for _ in range(r.choice([2, 3, 12, 25])):
            own = list(base)
            for _ in range(r.randint(0, max(1, len(own) // 25))):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append(" ".join(own[: len(own) - r.randint(0, len(own) // 8)]))
    rows += [" ".join(r.choices(vocabulary, k=r.randint(1, 80)) + passage * (i % 2)) for i in range(singles)]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("sizes", [{}, {"rare": 2}, {"rare": 0, "spread": 4}, {"rare": 3, "spread": 1000}, {"rare": 0, "spread": 8, "tile_cost": 1e9}, {"rounds": 1, "tile_rows": 4}, {"rounds": 1, "tile_cost": 1e9, "rare": 3}])
def test_equal_brute_force(spark, sizes):
    rows = near_copies(len(sizes))
    assert run(spark, rows, **sizes) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"Z{i % 977}{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "A\na"), (6, "A a"), (7, "a  a"), (8, "a b c d"), (9, "A\tB c\x0bd"), (9, "A\tB c\x0bd"),
            (None, "a"), (None, None), (10, long), (11, long.lower() + " end"), (12, "É x y z v"), (13, "é x y z v"), (14, "a b c d e f"), (15, "a\x1cb c d e f")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [], parts=1) == []


def test_long_texts_in_chunks(monkeypatch):
    text = " ".join(f"w{i}" for i in range(2000)) + "x" * 500
    whole = jaccard.shingles(text)
    monkeypatch.setattr(jaccard, "CHUNK", 97)
    assert np.array_equal(jaccard.shingles(text), whole)


def test_generated_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, jaccard.similar_documents(df).collect()), key=str) == brute(rows)


def test_cells_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        keys = np.sort(r.integers(0, 1 << 40, n, dtype=np.uint64))
        side = r.integers(0, 1 << 16, n, dtype=np.uint64)
        got = cells.unpack(cells.pack(keys, [(side, 2), (keys, 8)]), [2, 8])
        assert all(np.array_equal(a, b) for a, b in zip(got, (keys, side, keys)))
    data = r.integers(97, 99, 500).astype(np.uint8)
    rolling = cells.Rolling(data)
    a, b = r.integers(0, 480, 300), r.integers(0, 480, 300)
    same = np.array([data[x : x + 8].tobytes() == data[y : y + 8].tobytes() for x, y in zip(a, b)])
    assert np.array_equal(rolling.of(a, a + 8) == rolling.of(b, b + 8), same)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_cancel_in_a_polynomial_are_told_apart(spark):
    """Thue-Morse words and their complements have equal polynomial hashes modulo a power of two, whatever the odd base."""
    for n in (64, 128, 1024, 2048, 4096):
        a = thue_morse(n)
        b = a.translate(str.maketrans("ab", "ba"))
        assert jaccard.word_hashes(a.encode())[0] != jaccard.word_hashes(b.encode())[0]
        assert jaccard.word_hashes(f"{a} {b}".encode()).tolist() == [jaccard.word_hashes(x.encode())[0] for x in (a, b)]
    rows = [(1, "p q r s " + thue_morse(1024)), (2, "p q r s " + thue_morse(1024).translate(str.maketrans("ab", "ba")))]
    assert run(spark, rows) == brute(rows) == [(1, 1, 1), (2, 1, 2)]


def test_word_hashes_depend_on_place_and_length():
    words = ["a", "aa", "ab", "ba", "A" * 63, "a" * 64, "a" * 65, "a" * 66, "a" * 64 + "B", "é", "x" * 200 + "y", "x" * 199 + "yx"]
    got = jaccard.word_hashes(" ".join(words).encode())
    assert len(set(got.tolist())) == len(words)
    assert got.tolist() == jaccard.word_hashes(" ".join(w.upper() if w.isascii() else w for w in words).encode()).tolist()


def test_linked_sets_share_a_pair_at_every_size():
    """Two random sets at or above the threshold share an index pair, whatever the order of the shingles."""
    import random as rnd

    r = rnd.Random(7)
    for n in [2, 3, 4, 5, 8, 13, 30, 77, 200, 601]:
        for _ in range(6):
            common = -(-3 * n // 4)
            rest = r.randint(0, max(0, (4 * common - 3 * n) // 3))
            m = common + rest  # |A| = n, |A and B| = common, |union| = n + rest
            if 100 * common < 75 * (n + rest):
                continue
            pool = r.sample(range(1, 1 << 50), n + rest)
            a, b = sorted(pool[:n]), sorted(pool[:common] + pool[n:])
            for spread in (4, 8, 50):
                found = []
                for own in (a, b):
                    size = len(own)
                    step = jaccard.step_of(size)
                    take = size - -(-3 * size // 4) + 1 + jaccard.groups_at(step + 1, spread)
                    found.append(pairs_of(own[:take], size, spread))
                assert found[0] & found[1], (n, m, spread)


def pairs_of(own, n, spread):
    import pyarrow as pa

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([n]), pa.array([1]), pa.array([own], pa.list_(pa.int64()))], names=["id", "n", "component", "keys"])
    return {k for b in jaccard.pair_keys(Frame(), spread)([batch]) for k in b.column(0).to_pylist()}


@pytest.mark.parametrize("copies", [230])
def test_a_large_group_of_near_copies(spark, copies):
    """Frequent shingles (more than ``rare`` documents) at the default sizes, and texts that share a passage with the group but don't link."""
    r = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for _ in range(copies):
        own = list(base)
        for _ in range(r.randint(0, 6)):
            own[r.randrange(len(own))] = r.choice(["x", "y", "z"])
        rows.append(" ".join(own))
    rows += [" ".join(base[:60] + [f"t{k}_{i}" for i in range(40)]) for k in range(20) for _ in range(2)]
    rows = list(enumerate(rows))
    assert run(spark, rows) == brute(rows)
