"""Joins and distinct for large sides: Bloom semi-join, salted join, fingerprint distinct, co-partitioned layout."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blotter.functions.rowwise import part_of_day_counts
from blotter.operators import bloom, joins, skew
from blotter.operators.rank import top_k_per_group
from blotter.plans import part_of_day, stations
from blotter.plans.catalog import QUERIES
from blotter.sources import layout, periods

from .conftest import SF_SMALL, plan_text


# --- Bloom -----------------------------------------------------------------------------

def test_filter_keeps_every_key_and_drops_most_others(spark):
    keys = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), F.concat(F.lit("s"), "id").alias("s"))
    facts = spark.range(40_000).select(F.col("id").alias("k"), F.concat(F.lit("s"), "id").alias("s"), F.lit(1).alias("x"))
    kept = bloom.bloom_filtered(facts, keys, ["k", "s"], 10_000)
    assert kept.join(keys, ["k", "s"], "left_semi").count() == 10_000
    assert kept.count() < 10_000 + 0.03 * 30_000
    assert bloom.bloom_filtered(facts, keys.filter("k < 0"), ["k", "s"], 0).count() == 0


def test_filter_is_left_out_where_it_is_not_worth_it(spark):
    assert bloom.words_for(0) == 1 and bloom.words_for(100) == 25 and bloom.words_for(10**8) == bloom.MAX_WORDS
    assert bloom.words_for(10**9) is None
    facts = spark.range(10)
    assert bloom.bloom_filtered(facts, facts, ["id"], 1000, max_words=1) is facts
    dense = bloom.bloom_filtered(spark.range(2000), spark.range(300), ["id"], 30, max_words=2)  # more keys than told: still none lost
    assert dense.filter("id < 300").count() == 300
    with pytest.raises(ValueError, match="differ in type"):
        bloom.bloom_filtered(facts, spark.range(3).select(F.col("id").cast("int")), ["id"], 3)


def test_bloom_restriction_equals_others_and_filters_before_the_exchange(spark):
    facts = spark.range(3000).select((F.col("id") % 700).cast("double").alias("LAT"), F.when(F.col("id") % 11 != 0, F.col("id") % 5).cast("double").alias("LON"), "id")
    facts = facts.withColumn("LAT", F.when(F.col("id") % 50 == 0, F.lit(-0.0)).when(F.col("id") % 51 == 0, F.lit(float("nan"))).otherwise(F.col("LAT")))
    lookup = spark.range(400).select((F.col("id") % 90).cast("double").alias("LAT"), (F.col("id") % 5).cast("double").alias("LON"), (F.col("id") % 7).alias("z"))
    lookup = lookup.unionByName(spark.createDataFrame([(float("nan"), 1.0, 2), (0.0, 0.0, 2), (None, 1.0, 2)], "LAT double, LON double, z long"))
    dims = spark.createDataFrame([(2,), (3,), (3,)], "zz long")
    want = joins.restrict_by_dimension(facts, lookup, dims, "z", "zz", ["LAT", "LON"], "merge")
    got = joins.restrict_by_dimension(facts, lookup, dims, "z", "zz", ["LAT", "LON"], "bloom")
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()) and want.count() > 0
    lines = plan_text(got).splitlines()
    test = next(i for i, x in enumerate(lines) if "Filter" in x and "xxhash64" in x and "subquery" in x.lower())
    exchange = next(i for i, x in enumerate(lines) if "Exchange" in x)
    assert exchange < test  # a plan is printed from the top down
    with pytest.raises(ValueError):
        joins.restrict_by_dimension(facts, lookup, dims, "z", "zz", ["LAT", "LON"], "cuckoo")


# --- heavy hitters -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has key 7; some have none."""
    id_ = F.col("id")
    key = F.when(id_ % 3 == 0, 7).when(id_ % 100 == 1, None).otherwise(id_ % 500)
    return spark.range(30_000).select(id_, key.cast("long").alias("k"), (id_ % 13).alias("v"))


@pytest.mark.parametrize("how", skew.KINDS)
def test_salted_join_equals_plain(spark, skewed, how):
    dim = spark.range(0, 400).select(F.col("id").alias("k2"), (F.col("id") * 10).alias("w"))
    dim = dim.unionByName(dim.filter("k2 IN (7, 8)").withColumn("w", F.lit(-1).cast("long")))  # two rows of the hot key
    got = skew.salted_join(skewed, dim, [F.col("k")], [F.col("k2")], how, tasks=16)
    want = skewed.join(dim, F.col("k") == F.col("k2"), how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_key_is_spread_evenly_without_aqe(spark, skewed):
    dim = spark.range(0, 500).select(F.col("id").alias("k2"), F.lit(1).alias("w"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(held, ("false", "false", "24")):
            spark.conf.set(k, v)
        spread = lambda df: [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        plain = spread(skewed.join(dim.hint("merge"), F.col("k") == F.col("k2")))
        salted = spread(skew.salted_join(skewed, dim, [F.col("k")], [F.col("k2")]))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sum(plain) == sum(salted) and max(plain) > 10_000
    assert max(salted) < 4 * sum(salted) / 24


def test_salted_strategy_by_names_and_odd_inputs(spark, skewed):
    dim = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") % 13).alias("v"), F.lit("x").alias("w"))
    got = joins.join_with_strategy(skewed, dim, ["k", "v"], "inner", "salted")
    want = skewed.join(dim, ["k", "v"])
    assert sorted(got.columns) == sorted(want.columns) and got.count() == want.count()
    assert joins.join_with_strategy(skewed, dim.select("k"), "k", "left_semi", "salted").count() == skewed.join(dim, "k", "left_semi").count()
    assert skew.salted_join(skewed.filter("id < 0"), dim.select(F.col("k").alias("k2")), [F.col("k")], [F.col("k2")]).count() == 0
    none = skewed.withColumn("k", F.lit(None).cast("long"))
    assert skew.salted_join(none, dim.select(F.col("k").alias("k2")), [F.col("k")], [F.col("k2")]).count() == 0
    with pytest.raises(ValueError):
        joins.join_with_strategy(skewed, dim, skewed["k"] == dim["k"], "inner", "salted")
    with pytest.raises(ValueError):
        skew.salted_join(skewed, dim, [F.col("k")], [F.col("k")], "full")


def test_salts_follow_from_the_rows(spark, skewed):
    """A task that runs again must deal its rows the same way: no plan node may depend on the row's place."""
    dim = spark.range(0, 400).select(F.col("id").alias("k2"))
    plan = plan_text(skew.salted_join(skewed, dim, [F.col("k")], [F.col("k2")]))
    assert "monotonically" not in plan and "rand(" not in plan and "partition_id" not in plan


# --- distinct by fingerprint ---------------------------------------------------------------

def _odd_rows(spark):
    nan = float("nan")
    rows = [(1, "a", 0.5), (1, "a", 0.5), (2, None, nan), (2, None, nan), (3, "", 0.0), (3, "", -0.0), (4, None, None), (4, "", None), (None, None, None),
            (None, None, None), (None, None, None), (5, "b", 1.0)]
    return spark.createDataFrame(rows, "k long, s string, v double")


def _as_set(df):
    return sorted(str(tuple(0.0 if v == 0 and isinstance(v, float) else v for v in r)) for r in df.collect())


def test_fingerprint_distinct_equals_distinct(spark):
    df = _odd_rows(spark)
    assert _as_set(periods.distinct_by_fingerprint(df)) == _as_set(df.distinct())
    assert periods.distinct_by_fingerprint(df).columns == df.columns
    assert periods.distinct_by_fingerprint(df.filter("k < 0")).count() == 0
    halves = [df.select("v", "s", "k"), df]
    assert _as_set(periods.union_periods(halves, by_fingerprint=True).select("k", "s", "v")) == _as_set(df.distinct())
    assert periods.distinct_by_fingerprint(df, max_broadcast_bytes=1).count() == df.distinct().count()


def test_rows_that_only_share_a_fingerprint_stay(spark, monkeypatch):
    df = _odd_rows(spark)
    want = _as_set(df.distinct())

    class Colliding:
        def __getattr__(self, name):
            return getattr(F, name)

        @staticmethod
        def xxhash64(*columns):
            return F.coalesce(F.col("`k`") % 2, F.lit(0)).cast("long")

    monkeypatch.setattr(periods, "F", Colliding())
    assert _as_set(periods.distinct_by_fingerprint(df)) == want


def test_only_repeated_rows_are_shuffled_whole(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 50).alias("s"))
    plan = plan_text(periods.distinct_by_fingerprint(df.unionByName(df.limit(10))))
    assert plan.count("LeftAnti") and "BroadcastHashJoin" in plan
    alone, compared = plan[:plan.index("HashAggregate")], plan[plan.index("HashAggregate"):]
    assert "LeftAnti" in alone and "Exchange hashpartitioning" not in alone
    assert "LeftSemi" in compared and "LeftAnti" not in compared


# --- layout ------------------------------------------------------------------------------

def test_bucketed_tables_join_and_rank_without_exchange(spark, tmp_path):
    facts = spark.range(5000).select((F.col("id") % 300).alias("DR_NO"), F.col("id").alias("n"), F.when(F.col("id") % 9 != 0, F.col("id") % 20).alias("AREA"))
    dim = spark.range(15).select(F.col("id").alias("PREC"), F.concat(F.lit("d"), "id").alias("name"))
    before = {r["tableName"] for r in spark.sql("SHOW TABLES").collect()}
    laid, at = layout.bucketed(facts, ["AREA"], 6, str(tmp_path)), layout.bucketed(dim, ["PREC"], 6, str(tmp_path))
    joined = laid.join(at.hint("merge"), F.col("AREA") == F.col("PREC"))
    assert "Exchange" not in plan_text(joined) and "SortMergeJoin" in plan_text(joined)
    plain = facts.join(dim, F.col("AREA") == F.col("PREC"))
    assert sorted(map(tuple, joined.select("n", "name").collect())) == sorted(map(tuple, plain.select("n", "name").collect()))
    by_key = layout.bucketed(facts, ["DR_NO"], 6, str(tmp_path))
    ranked = top_k_per_group(by_key, ["DR_NO"], ["n"], 2)
    assert "Exchange" not in plan_text(ranked)
    assert sorted(map(tuple, ranked.select("DR_NO", "n").collect())) == sorted(map(tuple, top_k_per_group(facts, ["DR_NO"], ["n"], 2).select("DR_NO", "n").collect()))
    assert "Exchange" not in plan_text(by_key.groupBy("DR_NO").count())
    assert by_key.count() == 5000 and laid.filter("AREA IS NULL").count() == facts.filter("AREA IS NULL").count()
    assert {r["tableName"] for r in spark.sql("SHOW TABLES").collect()} == before


def test_bucketed_query_has_no_exchange_before_its_sums(spark):
    plan = plan_text(QUERIES["responsible_by_year_bucketed"](spark, SF_SMALL))
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in below


# --- the Arrow twin ------------------------------------------------------------------------

def test_arrow_twin_on_odd_clocks(spark):
    clocks = [None, 0, 359, 360, 400, 499, 500, 1159, 1160, 1199, 1200, 1659, 1660, 1700, 2059, 2060, 2099, 2100, 2359, -5, 99999]
    df = spark.createDataFrame([(c, "STREET") for c in clocks] * 3 + [(600, "street"), (600, None)], "`TIME OCC` int, `Premis Desc` string")
    told = lambda q: [tuple(r) for r in q(df).collect()]
    assert told(part_of_day.street_by_part_of_day_arrow) == told(part_of_day.street_by_part_of_day) == told(part_of_day.street_by_part_of_day_rdd)
    assert part_of_day.street_by_part_of_day_arrow(df.filter(F.lit(False))).collect() == []


def test_arrow_twin_sends_a_row_per_part_and_task():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array([c % 2400 for c in range(k, k + 1000)], pa.int32())], names=["clock"]) for k in range(0, 5000, 1000)]
    (out,) = part_of_day_counts(iter(batches))
    assert out.num_rows <= 5 and sum(out.column(1).to_pylist()) == 5000


def test_salted_and_plain_agree_on_stations(spark):
    inc = spark.createDataFrame([(1, 7, 34.0, -118.0), (2, 7, 34.1, -118.1), (3, None, 34.0, -118.0), (4, 99, 34.0, -118.0)] * 20, "DR_NO long, AREA int, LAT double, LON double")
    st = spark.createDataFrame([(-118.2, 34.05, "A", 7), (-118.3, 34.0, "B", 8)], "X double, Y double, DIVISION string, PREC long")
    a, b = (stations.with_responsible_station(inc, st, s) for s in ("salted", "merge"))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
