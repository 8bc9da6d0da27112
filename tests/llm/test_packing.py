from __future__ import annotations

import array
import bisect
import collections
import random
import zlib

import pytest

from blotter.llm import packing
from blotter.llm.queries import PACK_VOCABULARY
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(*PACK_VOCABULARY)


def library(encoder, text):
    return encoder.library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(encoder):
    r = random.Random(4)
    parts = ["the", "Été", "é", "<|endoftext|>", " ", "\t", "  ", "\n\n", "it's", "I'LL", "x" * 40, "\x1c", "\x85", "日本", "😀", "123", "ß!", "ǅ", "²", "​"]
    for _ in range(400):
        text = "".join(r.choice(parts) + r.choice(["", " ", "\n"]) for _ in range(r.randint(0, 12)))
        assert array.array("I", encoder.ids(text)).tolist() == library(encoder, text), text
    for c in range(0x250):
        text = f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1{chr(c)}\n{chr(c)}"
        assert array.array("I", encoder.ids(text)).tolist() == library(encoder, text), hex(c)


def plain_best_fit(lengths, capacity):
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, x)
        left = gaps.pop(i) if i < len(gaps) else capacity
        n += left == capacity
        if left > x:
            bisect.insort(gaps, left - x)
    return n


def check_sequences(placed, capacity):
    """(sequence, offset, length): gapless from 0, within the capacity."""
    sequences = collections.defaultdict(list)
    for s, o, n in placed:
        sequences[s].append((o, n))
    for own in sequences.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([8, 64, 1024])
    counts = collections.Counter(r.choice([r.randint(1, capacity), r.randint(1, capacity // 4)]) for _ in range(r.randint(0, 600)))
    placed = []
    for n, (ranks, first, offsets) in packing.plan(counts, capacity).items():
        ends = [*ranks[1:], counts[n]]
        placed += [(f + k, o, n) for a, b, f, o in zip(ranks, ends, first, offsets) for k in range(b - a)]
    assert check_sequences(placed, capacity) == plain_best_fit(counts.elements(), capacity) if counts else not placed


def test_generated_table(spark, encoder):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = packing.pack(docs, PACK_VOCABULARY).collect()
    own = collections.defaultdict(list)
    for r in out:
        own[r["doc_id"]].append(r)
    for d in docs.collect():
        ids, rows = [*library(encoder, d["text"]), 2], sorted(own[d["doc_id"]], key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows))) and len(rows) == -(-len(ids) // 1024)
        for r in rows:
            part = array.array("I", ids[r["start"] : r["start"] + r["length"]])
            assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        assert rows[0]["start"] == 0 and all(a["start"] + a["length"] == b["start"] for a, b in zip(rows, rows[1:]))
    n = check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in out], 1024)
    assert n == plain_best_fit([r["length"] for r in out], 1024)


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "a b"), (3, "word " * 3000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length int, rank string")
    out = packing.pack(df, PACK_VOCABULARY, capacity=64).collect()
    assert sum(r["doc_id"] == 1 for r in out) == 2 and sum(r["doc_id"] is None for r in out) == 1
    assert check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in out], 64)
    assert packing.pack(df.limit(0), PACK_VOCABULARY).count() == 0


def test_ranks_over_many_salts(spark):
    df = spark.range(500).selectExpr("id doc_id", "0 piece", "id % 3 + 1 length", "0L ids_crc32")
    ranked, counts = packing.ranked(df, per_salt=10)
    got = collections.defaultdict(list)
    for r in ranked.collect():
        got[r["length"]].append(r["rank"])
    assert all(sorted(v) == list(range(counts[k])) for k, v in got.items()) and sum(counts.values()) == 500
