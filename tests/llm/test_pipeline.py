from __future__ import annotations

import collections
import hashlib

import corpus_pipeline
from blotter.llm import mixing, packing, quality
from blotter.llm.queries import MIX_SEED, PACK_VOCABULARY, SOURCE_WEIGHTS
from tests.conftest import SF_SMALL
from tests.llm import test_jaccard, test_packing, test_suffixes


def brute_removed(rows):
    """The texts without repeated bytes, by the definition."""
    first = {}
    for doc_id, text in sorted(rows):
        data = text.encode()
        for i in range(len(data) - 99):
            first.setdefault(data[i : i + 100], (doc_id, i))
    out = {}
    for doc_id, text in rows:
        data = text.encode()
        gone = set()
        for i in range(len(data) - 99):
            if first[data[i : i + 100]] < (doc_id, i):
                gone.update(range(i, i + 100))
        out[doc_id] = bytes(b for k, b in enumerate(data) if k not in gone).decode("utf-8", "ignore")
    return out


def brute_copies(doc_id, rate):
    draw = int(hashlib.md5(f"{MIX_SEED}|{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    first, steps = mixing.poisson_steps(rate)
    return first + sum(x <= draw for x in steps)


def test_stages_equal_brute_force(spark, tmp_path):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs, want = documents, {r["doc_id"]: r["text"] for r in documents.collect()}
    chosen = quality.quality_rules(documents, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = {r["doc_id"] for r in chosen.filter("kept").collect()}
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        rows = out.collect()
        if k < 4:
            assert out.columns == documents.columns, name
        if k == 0:
            want = {i: t for i, t in want.items() if i in kept}
        elif k == 1:
            alone = {i for i, _, c in test_jaccard.brute(list(want.items())) if i == c}
            assert len(alone) < len(want)
            want = {i: t for i, t in want.items() if i in alone}
        elif k == 2:
            want = brute_removed(list(want.items()))
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif k == 3:
            counts = collections.Counter(source[i] for i in want)
            present = [s for s in SOURCE_WEIGHTS if counts[s]]
            rate = {s: len(want) / len(present) / counts[s] for s in present}
            copies = {i: brute_copies(i, rate[source[i]]) for i in want}
            assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter({i: n for i, n in copies.items() if n})
            assert {r["doc_id"]: r["text"] for r in rows} == {i: t for i, t in want.items() if copies[i]}
        if k < 3:
            assert {r["doc_id"]: r["text"] for r in rows} == want and len(rows) == len(want), name
        docs = out
    encoder = packing.Encoder(*PACK_VOCABULARY)
    total = sum(copies[i] * (len(test_packing.library(encoder, t)) + 1) for i, t in want.items())
    assert sum(r["length"] for r in rows) == total
    n = test_packing.check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 1024)
    assert n == test_packing.plain_best_fit([r["length"] for r in rows], 1024)
    assert names == ["quality rules", "n-gram Jaccard join", "suffix-array dedup", "mixing sources", "best-fit packing"]
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(rows)
    assert test_suffixes.brute([]) == []


def test_stages_take_odd_and_empty_documents(spark):
    odd = [(None, None, None, None, None), (1, None, "en", "src1", 0), (2, "", None, None, 0), (3, "x", "en", "src1", 1), (3, "x", "en", "src1", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, copy int, start string"
    df = spark.createDataFrame([(*r, 1, "s") for r in odd], schema)
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            out.collect()
            assert set(out.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
