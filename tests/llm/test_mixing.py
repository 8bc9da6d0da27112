from __future__ import annotations

import math

from pyspark.sql import functions as F

from blotter.llm import mixing


def docs(spark, n=6000):
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, "rare").when(F.col("id") % 11 == 0, F.lit(None)).otherwise("mid")
    return spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), source.alias("source"), F.lit(0).alias("copy"))


def test_steps_are_the_poisson_distribution():
    for rate in (0.0, 0.3, 1.0, 40.0, 900.0):
        first, steps = mixing.poisson_steps(rate)
        mean = sum((first + k) * (b - a) for k, (a, b) in enumerate(zip([0.0, *steps], steps)))
        assert abs(mean - rate) < 1e-6 * max(1, rate) and abs(steps[-1] - 1) < 1e-9
    assert abs(mixing.poisson_steps(1.0)[1][1] - 2 * math.exp(-1)) < 1e-12


def test_targets_are_met(spark):
    weights = {"hot": 1.0, "rare": 2.0, "mid": 1.0, "absent": 5.0}
    d = docs(spark)
    got = {r["source"]: r["n"] for r in mixing.mix(d, weights, default_rate=2.0).groupBy("source").agg(F.count("*").alias("n")).collect()}
    listed = d.filter("source IS NOT NULL").count()
    for s, w in (("hot", 1), ("rare", 2), ("mid", 1)):
        want = listed * w / 4
        assert abs(got[s] - want) < 6 * math.sqrt(want * 3)
    missing = d.filter("source IS NULL").count()
    assert abs(got[None] - 2 * missing) < 6 * math.sqrt(2 * missing)


def test_copies_are_numbered_repeatable_and_independent_of_partitions(spark):
    d = docs(spark, 500)
    a = sorted(map(tuple, mixing.mix(d, {"hot": 1.0, "mid": 3.0}, seed=3).collect()), key=str)
    b = sorted(map(tuple, mixing.mix(d.repartition(5, "text"), {"hot": 1.0, "mid": 3.0}, seed=3).collect()), key=str)
    assert a == b
    n = {}
    for r in a:
        n.setdefault(r[0], []).append(r[3])
    assert all(sorted(c) == list(range(len(c))) for c in n.values())


def test_odd_rows(spark):
    d = spark.createDataFrame([(None, None, None), (1, "", "a"), (1, "", "a")], "doc_id long, text string, source string")
    out = mixing.mix(d, {"a": 1.0}, default_rate=1.0).collect()
    assert len({(r["doc_id"], r["copy"]) for r in out}) * 2 >= len(out)
    assert mixing.mix(d, {"a": 0.0, "b": 1.0}, default_rate=0.0).count() == 0
    assert mixing.mix(d.limit(0), {"a": 1.0}).count() == 0
    assert "Python" not in mixing.mix(d, {"a": 1.0})._jdf.queryExecution().toString()


def test_clashing_names_stay(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(i, "src1", "t", 7, "a", 0.5, 3, "k") for i in range(40)], "doc_id long, source string, text string, copy int, DRAW string, draw_ double, times int, shuffle_key string")
    out = mixing.mix(df, {"src1": 1.0}, seed=1, copy="number", shuffle_key="place")
    assert out.columns == [*df.columns, "number", "place"]
    assert {(r.copy, r.DRAW, r.draw_, r.times, r.shuffle_key) for r in out.collect()} == {(7, "a", 0.5, 3, "k")}
    staged = corpus_pipeline.mixing_stage(spark, df, "")
    assert staged.columns == df.columns and {(r.copy, r.shuffle_key) for r in staged.collect()} == {(7, "k")}
