from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blotter.operators import joins
from blotter.operators.filters import drop_missing, exclude_keys, in_range, not_null
from blotter.operators.profile import row_counts, schema_report
from blotter.operators.rank import top_and_bottom_k, top_k_per_group

from .conftest import plan_text

NODE = {
    "broadcast": "BroadcastHashJoin",
    "merge": "SortMergeJoin",
    "shuffle_hash": "ShuffledHashJoin",
}


@pytest.fixture(scope="module")
def facts(spark):
    return spark.range(0, 2000).select(F.col("id"), (F.col("id") % 50).alias("k"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(0, 40).select(F.col("id").alias("k2"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("strategy", list(NODE))
def test_strategy_plans_and_results_agree(spark, facts, dim, strategy):
    out = joins.join_with_strategy(facts, dim, F.col("k") == F.col("k2"), "inner", strategy)
    assert NODE[strategy] in plan_text(out)
    base = facts.join(dim, F.col("k") == F.col("k2"))
    assert sorted(out.collect()) == sorted(base.collect())


def test_a_named_strategy_is_done_or_raises(spark, facts, dim):
    on = F.col("k") == F.col("k2")
    with pytest.raises(ValueError):
        joins.join_with_strategy(facts, dim, on, strategy="broadcast", max_broadcast_bytes=100)
    with pytest.raises(ValueError):
        joins.join_with_strategy(facts, dim, on, strategy="shuffle_replicate_nl")
    wide = dim.withColumn("s", F.repeat(F.lit("x"), 10_000)).withColumn("a", F.array("s"))
    _, size = joins.measured(wide)
    assert 40 * 20_000 < size < 40 * 21_000


def test_restrict_by_dimension_semi_semantics(spark):
    facts = spark.createDataFrame([(1.0, 2.0, "a"), (1.0, 2.0, "b"), (3.0, 4.0, "c"), (5.0, 6.0, "d")],
                                  "LAT double, LON double, x string")
    lookup = spark.createDataFrame([(1.0, 2.0, 10), (1.0, 2.0, 11), (3.0, 4.0, 12), (5.0, 6.0, 99)],
                                   "LAT double, LON double, z bigint")
    dims = spark.createDataFrame([(10,), (11,), (12,), (12,)], "zz bigint")
    for st in joins.STRATEGIES:
        got = joins.restrict_by_dimension(facts, lookup, dims, "z", "zz", ["LAT", "LON"], strategy=st)
        assert sorted(r.x for r in got.collect()) == ["a", "b", "c"], st


def test_top_k_per_group_total_order_and_window_group_limit(spark):
    df = spark.createDataFrame([(2015, m, c) for m, c in [(1, 5), (2, 5), (3, 7), (4, 1)]] + [(2016, 1, 2)],
                               "year int, month int, n bigint")
    out = top_k_per_group(df, ["year"], [F.desc("n"), F.asc("month")], 2)
    assert sorted(tuple(r) for r in out.collect()) == [(2015, 1, 5, 2), (2015, 3, 7, 1), (2016, 1, 2, 1)]
    assert "WindowGroupLimit" in plan_text(out)


def test_top_and_bottom_k(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 1, 1, 9, 7, 3])], "z int, v int")
    out = top_and_bottom_k(df, "v", 2, tie_break=["z"])
    assert [tuple(r) for r in out.collect()] == [(3, 9), (4, 7), (1, 1), (2, 1)]
    assert "TakeOrderedAndProject" in plan_text(out)


def test_filters_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (None, 4.0)], "k int, x double")
    assert not_null(df, "x").count() == 3
    assert drop_missing(df, ["x"]).count() == 2
    assert df.filter(in_range("k", 2, 3)).count() == 2
    assert sorted(r.k for r in exclude_keys(df, "k", [1]).collect()) == [2, 3]  # NULL key dropped too


def test_profile_operators(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, `b c` string")
    rc = {r.table: r.row_count for r in row_counts([("t", df), ("u", df.limit(1))]).collect()}
    assert rc == {"t": 2, "u": 1}
    rep = [tuple(r) for r in schema_report(df).collect()]
    assert rep == [(1, "a", "int", True, 2), (2, "b c", "string", True, 1)]


def test_drop_null_island(spark):
    from blotter.operators.filters import drop_null_island

    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (None, 0.0), (34.0, -118.0)], "LAT double, LON double")
    assert sorted(drop_null_island(df).collect(), key=str) == sorted(
        [r for r in df.collect() if not (r.LAT == 0.0 and r.LON == 0.0)], key=str)
