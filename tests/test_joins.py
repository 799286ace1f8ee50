"""Joins that keep hot keys off single tasks."""

import pytest
from pyspark.sql import functions as F

from geoscribe.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    rows = [(None, i) for i in range(700)] + [("hot", i) for i in range(900)] + [(f"k{i % 300}", i) for i in range(1_000)]
    left = spark.createDataFrame(rows, "k string, v long").repartition(8, "v")
    right = spark.createDataFrame([(None, -1), ("hot", -2)] + [(f"k{i}", i) for i in range(200)] + [("unused", 0)], "rk string, w long")
    return left, right


def test_hot_keys_are_few_and_right(spark, skewed):
    left, _ = skewed
    assert {r[0] for r in joins.hot_keys(left, ["k"], max_hot=10).collect()} == {None, "hot"}
    assert joins.hot_keys(left, ["k"], max_hot=10_000).count() == 302
    assert joins.hot_keys(left.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("max_hot", [2, 10, 10_000])
def test_hot_key_join_equals_plain_join(spark, skewed, how, max_hot):
    left, right = skewed
    got = joins.hot_key_join(left, right, [("k", "rk")], how, max_hot)
    want = left.join(right, left.k.eqNullSafe(right.rk), how).drop("rk")
    assert got.columns == ["k", "v", "w"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_rows_do_not_cross_the_network(spark, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # the rest is a shuffled join
    try:
        out = joins.hot_key_join(left, right, [("k", "rk")], max_hot=10)
        hot = out.where(F.col("k").isNull() | (F.col("k") == "hot"))
        largest = hot.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # 1,600 of 2,600 rows are hot; each stays in the partition it was read in.
    assert plan.count("BroadcastHashJoin") >= 3 and largest < 400


def test_unknown_kind_is_refused(skewed):
    with pytest.raises(ValueError):
        joins.hot_key_join(*skewed, [("k", "rk")], "full")


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(i, None if i % 50 == 0 else f"w{i % 400}") for i in range(4_000)] + [(i, "stop") for i in range(3_000)]
    members = [("stop",), ("absent",), (None,)] + [(f"w{i}",) for i in range(0, 400, 3)]
    return spark.createDataFrame(rows, "id long, k string"), spark.createDataFrame(members, "m string")


@pytest.mark.parametrize("words", [1, 16, 1 << 12])
def test_bloom_anti_join_is_exact_for_any_filter(keyed, words):
    """One word is a filter that lets nearly everything through; the result stays the same."""
    df, members = keyed
    want = df.join(members, df.k == members.m, "left_anti")
    got = joins.bloom_anti_join(df, members, "k", words)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("k is null").count() == 80
    assert joins.bloom_anti_join(df.limit(0), members, "k").count() == 0
    assert joins.bloom_anti_join(df, members.limit(0), "k").count() == df.count()


def test_bloom_anti_join_past_the_bound_of_false_positives(keyed, monkeypatch):
    df, members = keyed
    want = df.join(members, df.k == members.m, "left_anti")
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    got = joins.bloom_anti_join(df, members, "k", 1)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_anti_join_past_the_bound_shuffles_no_rows(spark, keyed):
    df, members = keyed
    out = joins.anti_join(df, members, "k", max_rows=2)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(k" not in plan
    assert joins.bloom_words(members).count() <= 136


def test_dimension_join_checks_the_size(spark, skewed):
    left, right = skewed
    want = sorted(map(str, left.join(right, left.k.eqNullSafe(right.rk)).drop("rk").collect()))
    for bound in (1, None):
        got = joins.dimension_join(left, right, [("k", "rk")], max_rows=bound)
        assert sorted(map(str, got.collect())) == want


# ------------------------------------------------------------------ hour histograms

def _hours(rows, dim):
    from collections import Counter

    by_key = {k: (g, o) for k, g, o in dim}
    return Counter((by_key[k][0], (s + by_key[k][1]) % 86_400 // 3600) for k, s in rows if k in by_key)


@pytest.mark.parametrize("offsets,slot", [((0, 3600, -7200), 3600), ((900, -1800, 20_700), 900), ((1, 3601, -86_399), 1)])
@pytest.mark.parametrize("bound", [None, 0])
def test_hour_histogram(spark, offsets, slot, bound):
    from geoscribe.operators import hours

    dim = [(k, f"g{k % 4}", offsets[k % 3]) for k in range(60)]
    rows = [(k % 70, (k * 7_919) % 86_400) for k in range(3_000)] + [(7, (k * 31) % 86_400) for k in range(3_000)] + [(None, 5)]
    facts = spark.createDataFrame(rows, "k int, s int").repartition(6, "s")
    who = spark.createDataFrame(dim, "key int, grp string, off int")
    assert hours.slot_seconds(who, "off") == slot
    got = hours.hour_histogram(facts, "k", F.col("s"), who, "key", "grp", "off", max_rows=bound, max_hot=5)
    assert {(r.grp, r.hour): r.n for r in got.collect()} == _hours(rows, dim)


def test_hour_histogram_shuffles_histograms_only(spark):
    """A hot key's rows, and any key's, reach an exchange as counts."""
    from geoscribe.operators import hours

    facts = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 9).cast("int").alias("k"),
                                       (F.col("id") % 86_400).cast("int").alias("s"))
    who = spark.createDataFrame([(k, "g", 0) for k in range(9)], "key int, grp string, off int")
    out = hours.hour_histogram(facts, "k", F.col("s"), who, "key", "grp", "off", max_rows=0, max_hot=3)
    out.collect()
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(_key" in line]
    assert all("HashAggregate" in lines[i + 1] for i in exchanges)


def test_inner_hot_key_join_chooses_no_rows_before_it(spark, skewed):
    left, right = skewed
    plan = joins.hot_key_join(left, right, [("k", "rk")], max_hot=10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1                     # the rows of the right side for hot keys
