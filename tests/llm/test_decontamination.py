from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from blotter.llm import decontamination as D
from blotter.llm import queries
from tests.conftest import SF_SMALL, plan_text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    windows = []
    for item_id, text in items:
        w = words(text)
        size = min(n, len(w))
        windows += [(item_id, tuple(w[i : i + size])) for i in range(len(w) - size + 1) if size]
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    if item_id is not None:
                        found.add(str(item_id))
        told = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), told, bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in docs], "doc_id long, text string, n_words int, key string, hash int")
    b = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, window int")
    return d, b


def run(spark, docs, items, **more):
    return sorted(map(tuple, D.digests(D.contamination(*frames(spark, docs, items), **more)).collect()), key=str)


def planted(seed=1, n_docs=60, n_items=25, vocabulary=30):
    r = random.Random(seed)
    pool = [f"w{i}" for i in range(vocabulary)] + ["Ünï", "Ñu", "x9"]
    text = lambda k: "".join(r.choice(pool) + r.choice([" ", ", ", ".\n", "_", " — "[:1]]) for _ in range(k))
    items = [(i, text(r.choice([1, 2, 3, 5, 9, 10, 11, 25]))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        parts = [text(r.randrange(0, 40))]
        for _ in range(r.randrange(3)):
            parts += [r.choice(items)[1].upper() if r.random() < 0.3 else r.choice(items)[1], text(r.randrange(0, 12))]
        docs.append((i, "".join(parts)))
    return docs, items


@pytest.mark.parametrize("n", [10, 3])
def test_equal_brute_force(spark, n):
    docs, items = planted()
    assert run(spark, docs, items, n=n) == brute(docs, items, n)


def test_window_groups_lose_nothing(spark):
    docs, items = planted(2)
    assert run(spark, docs, items, max_broadcast_bytes=60_000) == brute(docs, items)


def test_odd_rows(spark):
    ten = "a b c d e f g h i j"
    docs = [(1, None), (2, ""), (3, " .,\n"), (None, ten), (None, ten), (4, ten), (4, ten), (4, "z " + ten), (5, "A-B-C_D e\tf\x00g h i jé"), (6, ten + " " + ten)]
    items = [(7, ten), (7, "q r"), (None, "z"), (8, None), (9, ""), (10, "..."), (11, ten)]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []
    assert run(spark, [(None, None), (3, None)], items) == brute([(None, None), (3, None)], items)


def test_very_long_text_and_one_long_word(spark):
    ten = "a b c d e f g h i j"
    docs = [(1, "x " * 400_000 + ten + " y" * 400_000), (2, "w" * 3_000_000)]
    assert run(spark, docs, [(1, ten)]) == [(1, 800_010, 10, 1, hashlib.sha256(b"1").hexdigest(), True), (2, 1, 0, 0, hashlib.sha256(b"").hexdigest(), False)]


def test_equal_hashes_do_not_contaminate(spark, monkeypatch):
    """With a hash that tells nothing apart, only the words decide."""
    constant = lambda *c: F.when(c[0].isNotNull() if not isinstance(c[0], str) else F.col(c[0]).isNotNull(), F.lit(1).cast("long"))
    docs, items = planted(3, n_docs=12, n_items=6)
    monkeypatch.setattr(D.F, "xxhash64", constant)
    assert run(spark, docs, items) == brute(docs, items)
    loose = run(spark, docs, items, verify=False)
    assert loose != brute(docs, items)


def test_a_passage_that_all_share_and_many_copies(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = [(i, f"{i} {ten} {i}") for i in range(300)] + [(1000, ten)] * 300
    got = run(spark, docs, [(1, ten), (2, "zero " + ten)])
    assert got == brute(docs, [(1, ten), (2, "zero " + ten)]) and len(got) == 600


def test_removal(spark):
    ten = "a b c d e f g h i j"
    docs = [(1, "Keep this.  A b C d, e f g h I j! And that\n"), (2, "nothing here"), (3, None), (4, ten), (5, "é " + ten + ".")]
    d, b = frames(spark, docs, [(1, ten)])
    got = {r["doc_id"]: r["text"] for r in D.decontaminate(d, b).collect()}
    assert got == {1: "Keep this! And that\n", 2: "nothing here", 3: None, 4: "", 5: "é."}
    assert D.decontaminate(d, b).columns == d.columns
    kept = D.decontaminate(d, b, drop="documents")
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3] and kept.columns == d.columns
    clean = {r[0]: r[5] for r in map(tuple, D.digests(D.contamination(D.decontaminate(d, b), b)).collect())}
    assert not any(clean.values())
    with pytest.raises(ValueError):
        D.decontaminate(d, b, drop="words")


def test_generated_table_and_plan(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    df = queries.op11_decontamination(spark, SF_SMALL)
    assert sorted(map(tuple, df.collect()), key=str) == brute(docs, items)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan_text(df))
