"""Joins with hot keys, duplicates, upsert."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators import dedup
from tillflow.operators.joins import fan_out_left_join, hot_keys, salted_join
from tillflow.operators.upsert import upsert


def skewed(spark, n=6000):
    """Facts of which a third carry key 0, in identical copies, and a tenth no key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(0, n, 1, 8).select(key.cast("int").alias("k"), (F.col("id") % 7).cast("int").alias("v"))


def lookup(spark):
    return spark.range(0, 400).where("id % 5 <> 4").select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))


def test_hot_keys_are_few(spark):
    df = skewed(spark)
    assert rows(hot_keys(df, ["k"], 0.2)) == [(0,)]
    assert hot_keys(df, ["k"], 1 / 1000).count() < 1000
    assert hot_keys(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, no_broadcast, how):
    facts, small = skewed(spark), lookup(spark)
    plain = facts.join(small, ["k"], how)
    salted = salted_join(facts, small, ["k"], how, hot=hot_keys(facts, ["k"], 0.01), salts=8)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salted_join_splits_the_hot_key(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = skewed(spark)
        joined = salted_join(facts, lookup(spark), ["k"], hot=hot_keys(facts, ["k"], 0.01), salts=64)
        sizes = [r["count"] for r in joined.where("k = 0").groupBy(F.spark_partition_id()).count().collect()]
        nulls = [r["count"] for r in joined.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = facts.where("k = 0").count()
    assert sum(sizes) == hot and len(sizes) == 4 and max(sizes) < 0.6 * hot
    assert len(nulls) >= 4


def test_fan_out_left_join(spark, no_broadcast):
    unique = spark.range(0, 50).select(F.when(F.col("id") < 49, F.col("id")).alias("k"), (F.col("id") * 10).alias("a"))
    # Key 7 holds most rows on the right, keys above 30 have none.
    repeated = spark.range(0, 2000, 1, 8).select(
        F.when(F.col("id") % 4 != 0, 7).otherwise(F.col("id") % 30).alias("k"), (F.col("id") % 11).alias("b"))
    got = fan_out_left_join(unique, repeated, ["k"], hot=hot_keys(repeated, ["k"], 0.05), salts=16)
    want = unique.join(repeated, "k", "left")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_keep_one_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "p"), ("b", None, "q"), (None, 1, "n"), (None, 2, "m")],
        "k string, t int, v string")
    assert rows(dedup.keep_latest(df, ["k"], ["t"])) == [(None, 2, "m"), ("a", 3, "y"), ("b", None, "q")]
    assert rows(dedup.keep_first(df, ["k"], ["t"])) == [(None, 1, "n"), ("a", 1, "x"), ("b", None, "q")]
    once = dedup.keep_latest(df, ["k"], ["t"])
    assert rows(dedup.keep_latest(once, ["k"], ["t"])) == rows(once)


def test_survivor_does_not_depend_on_row_order(spark):
    df = spark.range(0, 300).select((F.col("id") % 3).alias("k"), F.lit(1).alias("t"), F.col("id").alias("v"))
    results = {tuple(rows(dedup.keep_latest(df.repartition(n), ["k"], ["t"]))) for n in (1, 3, 7)}
    assert results == {((0, 1, 297), (1, 1, 298), (2, 1, 299))}


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = dedup.keep_latest(skewed(spark), ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index(", Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # printed top down: the partial limit runs below the exchange


def test_distinct_and_blank_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (" a ", 1), ("", 2), ("\t", 3), (None, 4)], "k string, v int")
    assert dedup.distinct_rows(df).count() == 5
    assert rows(dedup.drop_blank_keys(df, ["k"])) == [("a", 1), ("a", 1), ("a", 1)]
    numbers = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(dedup.drop_blank_keys(numbers, ["k"])) == [(1,)]


def test_upsert(spark, no_broadcast):
    schema = "k string, v int, n int"
    base = spark.createDataFrame([("a", 1, 0), ("b", 1, 0), (None, 1, 0)], schema)
    updates = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 2, 1), (None, 2, 1), (None, 2, 1)], schema)
    out = upsert(base, updates, ["k"], ["n"])
    assert rows(out) == [(None, 1, 0), (None, 2, 1), (None, 2, 1), ("a", 1, 0), ("b", 3, 2), ("c", 2, 1)]
    assert rows(upsert(out.where("k IS NOT NULL"), updates.where("k IS NOT NULL"), ["k"], ["n"])) == rows(
        out.where("k IS NOT NULL"))
    assert upsert(base, updates).count() == 8
