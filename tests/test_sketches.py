"""Mergeable summaries against exact counts, as-of features against one run per date, buckets against plain joins."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators import features as feat
from tillflow.operators import sketches
from tillflow.operators.dashboards import top_products
from tillflow.sinks.bucketed import SkewedBucket, bucketing, buckets_for, forget, write_bucketed
from tillflow.sinks.tables import read_batches, write_batch


def test_merged_sketches_keep_their_bound_and_equal_one_sketch(spark):
    sales = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("store"),
        (F.col("id") % 30).alias("day"), F.when(F.col("id") % 97 != 0, F.xxhash64("id") % 9000).alias("buyer"))
    states = sketches.distinct_states(sales, ["store", "day"], "buyer")
    merged = sketches.distinct_estimate(sketches.merge_distinct(states, ["store"]), "estimate")
    whole = sketches.distinct_estimate(sketches.distinct_states(sales, ["store"], "buyer"), "estimate")
    exact = {r.store: (r.n, r.rows) for r in sales.groupBy("store").agg(F.count_distinct("buyer").alias("n"), F.count("*").alias("rows")).collect()}
    for r in merged.collect():
        assert r.rows == exact[r.store][1] and abs(r.estimate - exact[r.store][0]) <= sketches.relative_error() * exact[r.store][0]
    for a, b in zip(rows(merged), rows(whole), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) <= 0.02 * b[2]
    assert sketches.merge_distinct(states.limit(0), ["store"]).count() == 0


def states_of(spark, path, items, batches, keep):
    for b in range(batches):
        write_batch(sketches.top_state(items.where(F.col("batch") == b), keep), path, b)
    return read_batches(spark, path, "key bigint, amount double, cut double")


@pytest.mark.parametrize("keep, skewed", [(5, True), (40, True), (3, False), (1000, False)])
def test_best_sellers_are_exact_whatever_the_lists_miss(spark, tmp_path, keep, skewed):
    draw = random.Random(keep)
    weight = (lambda k: 1000 / (k + 1)) if skewed else (lambda k: 1)
    lines = [(k, b, 1, round(draw.uniform(0, 2) * weight(k), 2)) for k in range(80) for b in range(4) for _ in range(3) if draw.random() < 0.8]
    items = spark.createDataFrame(lines, "product_id long, batch int, quantity int, total_price double")
    states = states_of(spark, str(tmp_path / "top"), items, 4, keep)
    found = sketches.candidates(states, 5)
    truth = items.groupBy("product_id").agg(F.sum("total_price").alias("s")).collect()
    named = {r.key for r in found.keys.collect()}
    # Whatever is not a candidate sums up to no more than the bound, and the best are candidates if the bound is low enough.
    held = {r.key for r in states.select("key").collect()}
    assert all(r.s <= found.missed + 1e-9 for r in truth if r.product_id not in held)
    if found.complete:
        assert {r.product_id for r in top_products(items, 5).collect()} <= named
    assert found.complete or keep < 1000
    assert [tuple(r) for r in sketches.best_sellers(items, states, 5).collect()] == [tuple(r) for r in top_products(items, 5).collect()]


def test_lists_of_batches_without_sales(spark, tmp_path):
    items = spark.createDataFrame([(1, 0, 1, 5.0), (2, 0, 1, None)], "product_id long, batch int, quantity int, total_price double")
    states = states_of(spark, str(tmp_path / "top"), items, 2, 10)
    assert rows(sketches.best_sellers(items, states, 5), "product_id", "revenue") == [(1, 5.0), (2, None)]
    assert sketches.candidates(states.limit(0), 3).complete


@pytest.mark.parametrize("dates", [("2025-01-31", "2025-02-28", "2025-03-31"), ("2025-02-10 12:30:00", "2025-03-01 00:00:01")])
def test_features_of_many_dates_equal_one_run_per_date(spark, dates):
    draw = random.Random(4)
    start = datetime(2024, 12, 20)
    bought, lines = [], []
    for i in range(600):
        who = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"c{draw.randrange(12)}"
        at = None if i % 70 == 5 else start + timedelta(days=draw.randrange(110), minutes=draw.choice([0, 0, 300, 750, 1439]))
        bought.append((i, who, at, draw.choice([None, 100.0, 900.0, 3000.0])))
        lines += [(who, at, draw.choice([None, "p1", "p2"]), draw.choice([None, "milk", "fruits", "veggies", "bakery", "meat"])) for _ in range(draw.randrange(3))]
    purchases = spark.createDataFrame(bought, "purchase_id long, customer_id string, purchase_datetime timestamp, total_amount double")
    items = spark.createDataFrame(lines, "customer_id string, purchase_datetime timestamp, product_id string, category string")
    got = feat.features_at(purchases, items, dates).withColumn("as_of", F.col("as_of").cast("string"))
    want = None
    for d in dates:
        upto = F.col("purchase_datetime") <= F.lit(d).cast("timestamp")
        one = feat.customer_features(purchases.where(upto), items.where(upto), as_of=d, windowed=True).withColumn(
            "as_of", F.lit(d).cast("timestamp").cast("string"))
        want = one if want is None else want.unionByName(one)
    assert rows(got.select(want.columns)) == rows(want)
    assert feat.features_at(purchases.limit(0), items.limit(0), dates).count() == 0


def test_a_hot_customers_timeline_grows_with_days_not_rows(spark):
    many = spark.range(20_000).select(F.col("id").alias("purchase_id"), F.lit("hot").alias("customer_id"), F.lit(1.0).alias("total_amount"),
                                      F.timestamp_seconds(F.lit(1735689600) + F.col("id") * 40).alias("purchase_datetime"))
    none = spark.createDataFrame([], "customer_id string, purchase_datetime timestamp, product_id string, category string")
    out = feat.features_at(many, none, ("2025-01-20",))
    assert out.count() == 1
    from metrics import walk_metrics
    assert max(walk_metrics(out, "Window", "numOutputRows") or [0]) <= 2 * 11 + 1


@pytest.fixture
def stored(spark, tmp_path):
    items = spark.range(4000).select((F.col("id") % 700).alias("purchase_id"), (F.col("id") % 9).alias("product_id"), (F.col("id") * 1.0).alias("price"))
    header = spark.range(600).select(F.col("id").alias("purchase_id"), F.concat(F.lit("c"), F.col("id") % 50).alias("customer_id"))
    tables = (write_bucketed(items, "t_items", str(tmp_path / "items"), ["purchase_id"], 8),
              write_bucketed(header, "t_header", str(tmp_path / "header"), ["purchase_id"], 8))
    yield items, header, *tables
    forget(spark, "t_items", "t_header")


def test_bucketed_tables_join_and_group_without_an_exchange(spark, no_broadcast, stored):
    items, header, lines, purchases = stored
    joined = lines.join(purchases, "purchase_id", "left").groupBy("purchase_id", "customer_id").agg(F.sum("price").alias("s"))
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
    plain = items.join(header, "purchase_id", "left").groupBy("purchase_id", "customer_id").agg(F.sum("price").alias("s"))
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(plain) and bucketing(spark, "t_items") == (8, ["purchase_id"])
    assert len(lines.inputFiles()) == 8  # every bucket is one file


def test_buckets_grow_with_the_table(spark):
    assert [buckets_for(spark.range(n), rows=100) for n in (0, 800, 801, 5000)] == [8, 8, 9, 50]


def test_a_hot_key_is_no_bucketing_key(spark, tmp_path):
    hot = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    with pytest.raises(SkewedBucket):
        write_bucketed(hot, "t_hot", str(tmp_path / "hot"), ["k"], 16)
