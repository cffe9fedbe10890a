"""The two marts, the delta, and the features, on edge rows."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators import counting, dashboards, mart, quality
from tillflow.operators import features as feat
from tillflow.plans.jobs import feature_table
from tillflow.schemas import MART_COLUMNS

NOW = "2025-01-31 12:00:00"
SCHEMA = ("purchase_id string, customer_id string, store_id string, total_amount double, payment_method string, "
          "is_delivery int, purchase_datetime timestamp")


def t(day, hour=0):
    return datetime(2025, 1, day, hour)


@pytest.fixture(scope="module")
def purchases(spark):
    return spark.createDataFrame([
        ("o1", "a", "s1", 100.0, "cash", 1, t(1)),
        ("o2", "a", "s2", None, "CARD", 0, t(5)),
        ("o3", "a", "s2", 50.0, "card", 1, None),
        (None, "a", None, 25.0, None, None, t(9)),
        ("o4", "b", "s1", float("nan"), "card", 0, t(2)),
        ("o5", None, "s1", 10.0, "cash", 0, t(3)),
    ], SCHEMA)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([
        ("a", datetime(2025, 1, 1, 13), 1),     # 29 days and 23 hours before NOW
        ("a", datetime(2025, 1, 20), 0),
        ("z", datetime(2020, 1, 1), 1),
    ], "customer_id string, registration_date timestamp, is_loyalty_member int")


def by_customer(df):
    return {r.customer_id: r.asDict() for r in df.collect()}


def test_tolerant_mart(spark, purchases, customers):
    out = mart.customer_mart(purchases, customers, as_of=NOW)
    assert out.columns == list(MART_COLUMNS)
    got = by_customer(out)
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a["purchase_count"], a["total_spent"], a["avg_basket"]) == (3, 175.0, 43.75)  # NULL counts as 0
    assert (a["distinct_stores"], a["cash_count"], a["card_count"], a["delivery_count"]) == (2, 1, 2, 2)
    assert (a["first_purchase"], a["last_purchase"]) == (t(1), t(9))
    assert (a["new_customer"], a["is_loyalty_member"], a["registration_date"]) == (1, 1, datetime(2025, 1, 1, 13))
    assert (got["b"]["total_spent"], got["b"]["new_customer"], got["b"]["registration_date"]) == (0.0, 0, None)


def test_sql_mart(spark, purchases, customers):
    out = mart.customer_mart_sql(purchases.where("NOT isnan(coalesce(total_amount, 0))"), customers, as_of=NOW)
    got = rows(out, "customer_id", "purchase_count", "total_spent", "cash_count", "card_count", "new_customer",
               "is_loyalty_member")
    # NULL is a customer, customer a comes twice, only the exact text "card" counts; 30 calendar days are not < 30.
    assert got == [(None, 1, 10.0, 1, 0, 0, 0), ("a", 4, 175.0, 1, 1, 0, 1), ("a", 4, 175.0, 1, 1, 1, 0)]
    assert out.where("customer_id = 'a'").first().avg_basket == pytest.approx(175 / 3)


def test_marts_agree_on_clean_input(spark, no_broadcast):
    clean = spark.range(0, 500).select(
        F.col("id").cast("string").alias("purchase_id"), (F.col("id") % 37).cast("string").alias("customer_id"),
        (F.col("id") % 5).cast("string").alias("store_id"), (F.col("id") * 1.0).alias("total_amount"),
        F.lit("card").alias("payment_method"), F.lit(0).alias("is_delivery"),
        F.lit(t(1)).alias("purchase_datetime"))
    who = spark.range(0, 30).select(
        F.col("id").cast("string").alias("customer_id"), F.lit(datetime(2024, 12, 1)).alias("registration_date"),
        F.lit(1).alias("is_loyalty_member"))
    tolerant = mart.customer_mart(clean, who, as_of=NOW)
    assert rows(tolerant) == rows(mart.customer_mart_sql(clean, who, as_of=NOW))
    assert tolerant.agg(F.sum("purchase_count")).first()[0] == 500


def test_future_registration_is_new_in_both(spark, purchases):
    who = spark.createDataFrame([("b", datetime(2026, 1, 1), 0)], "customer_id string, registration_date timestamp, is_loyalty_member int")
    for build in (mart.customer_mart, mart.customer_mart_sql):
        assert by_customer(build(purchases, who, as_of=NOW))["b"]["new_customer"] == 1


def test_text_and_missing_columns(spark):
    few = spark.createDataFrame([("o1", "a", "s1", "12.5"), ("o2", "a", "s1", "oops")],
                                "purchase_id string, customer_id string, store_id string, total_amount string")
    got = by_customer(mart.customer_mart(few, spark.createDataFrame([("a", "2025-01-30")], "customer_id string, registration_date string"), as_of=NOW))["a"]
    assert (got["total_spent"], got["cash_count"], got["delivery_count"], got["first_purchase"]) == (12.5, 0, 0, None)
    assert (got["new_customer"], got["is_loyalty_member"]) == (1, 0)


def test_empty_input_gives_an_empty_mart_with_its_schema(spark, purchases, customers):
    out = mart.customer_mart(purchases.limit(0), customers, as_of=NOW)
    assert out.columns == list(MART_COLUMNS) and out.count() == 0
    assert mart.customer_mart(purchases, customers.limit(0), as_of=NOW).count() == 2


# --- features -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def basket(spark):
    header = spark.createDataFrame([
        ("o1", "a", 1500.0, t(1)), ("o2", "a", 1500.0, t(2)), ("o3", "a", 1500.0, t(31, 13)),
        ("o4", "b", 100.0, datetime(2024, 11, 1)), ("o5", "c", 500.0, datetime(2024, 12, 31)),
    ], "purchase_id string, customer_id string, total_amount double, purchase_datetime timestamp")
    items = spark.createDataFrame([
        ("o1", "p1", "milk"), ("o1", "p1", "milk"), ("o2", "p2", "veggies"), ("o4", "p3", "fruits"), ("o4", "p4", "meat"),
        ("o4", None, "bakery"),
    ], "purchase_id string, product_id string, category string")
    return header, header.join(items, "purchase_id")


FLAGS = ["bought_milk_last_30d", "bought_fruits_last_14d", "not_bought_veggies_14d", "buys_bakery"]


def test_features_as_coded(spark, basket):
    out = feat.customer_features(*basket, as_of=NOW)
    assert rows(out, "customer_id", *FLAGS) == [
        ("a", True, False, False, False), ("b", False, True, True, False), ("c", False, False, True, False)]
    assert rows(out, "customer_id", "recurrent_buyer", "bulk_buyer", "low_cost_buyer", "active_today", "inactive_30d") == [
        ("a", True, True, False, True, False), ("b", False, False, True, False, True), ("c", False, False, False, False, True)]


def test_features_windowed(spark, basket):
    out = feat.customer_features(*basket, as_of=NOW, windowed=True)
    assert rows(out, "customer_id", *FLAGS) == [  # milk on day 1 is older than 30 days, veggies on day 2 than 14
        ("a", False, False, True, False), ("b", False, False, True, False), ("c", False, False, True, False)]
    assert rows(out.where("inactive_30d"), "customer_id") == [("b",), ("c",)]


def test_window_bounds(spark):
    lines = spark.createDataFrame(
        [("in", "p", "milk", t(1, 12)), ("early", "p", "milk", t(1, 11)), ("late", "p", "milk", t(31, 13))],
        "customer_id string, product_id string, category string, purchase_datetime timestamp")
    out = feat.category_flags(lines, feat.CATEGORY_FLAGS[:1], as_of=NOW, windowed=True)
    assert rows(out.where("bought_milk_last_30d"), "customer_id") == [("in",)]


def test_unique_purchases_gives_the_same(spark, basket):
    assert rows(feat.purchase_features(basket[0], as_of=NOW)) == rows(
        feat.purchase_features(basket[0], as_of=NOW, unique_purchases=True))


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([("o1", "a", 1000.0, t(1)), ("o2", "b", 200.0, t(31))],
                               "purchase_id string, customer_id string, total_amount double, purchase_datetime timestamp")
    out = feat.purchase_features(df, as_of=NOW)
    assert rows(out, "bulk_buyer", "low_cost_buyer", "active_today") == [(False, False, False)] * 2


def test_feature_table_from_item_text(spark):
    schema = SCHEMA + ", items_json string"
    purchases = spark.createDataFrame([
        ("o1", "a", "s1", 100.0, "cash", 0, t(30), '[{"product_id":"p1"},{"product_id":"p2"},{"product_id":"p9"}]'),
        ("o2", "a", "s1", 3000.0, "cash", 0, t(30), "[]"),
    ], schema)
    products = spark.createDataFrame([("p1", "🥛🥛 Молочные продукты"), ("p2", "🥩🥩 мясо, рыба, яйца и бобовые")],
                                     "product_id string, category string")
    plain = feature_table(purchases, products, as_of=NOW, windowed=True, vegetarian=True).first()
    assert (plain.bought_milk_last_30d, plain.vegetarian_profile, plain.bulk_buyer) == (True, False, True)
    weighted = feature_table(purchases, products, as_of=NOW, item_weighted=True).first()
    assert weighted.bulk_buyer is False  # (3 × 100 + 3000) / 4 = 825
    profile = feat.with_profile(feature_table(purchases, products, as_of=NOW),
                                mart.customer_mart(purchases, purchases.select("customer_id").limit(0), as_of=NOW)).first()
    assert (profile.new_customer, profile.is_loyalty_member) == (0, 0)


def test_category_group(spark):
    df = spark.createDataFrame([("🥦🥦 Овощи и зелень",), ("Other",), (None,)], "c string")
    assert rows(df.select(feat.category_group(F.col("c")).alias("g"))) == [(None,), ("other",), ("veggies",)]


# --- counts, panels, quality ------------------------------------------------------------------------


def test_counts(spark):
    df = spark.createDataFrame([("g", "p1", 1), ("g", "p1", 1), ("g", "p2", 0), ("g", None, 1), ("h", "p1", 0)], "g string, p string, f int")
    hit = {"hits": F.col("f") == 1}
    assert rows(counting.conditional_counts(df, ["g"], hit)) == [("g", 4, 3), ("h", 1, 0)]
    assert rows(counting.conditional_distinct(df, ["g"], "p", hit)) == [("g", 1), ("h", 0)]
    assert rows(counting.distinct_count(df, ["g"], "p", "n")) == [("g", 2), ("h", 1)]
    assert rows(counting.distinct_count(df, ["g"], "p", "n", approximate=True)) == [("g", 2), ("h", 1)]


def test_panels(spark, purchases):
    stores = spark.createDataFrame([("s1", "One", "X"), ("s2", "Two", "X")], "store_id string, store_name string, city string")
    amounts = purchases.fillna(0.0)
    assert rows(dashboards.revenue_by_store(amounts, stores), "store_id", "purchases", "revenue", "store_name") == [
        (None, 1, 25.0, None), ("s1", 3, 110.0, "One"), ("s2", 2, 50.0, "Two")]
    assert rows(dashboards.revenue_by_region(amounts, stores)) == [(None, 1, 25.0, 0), ("X", 5, 160.0, 2)]
    assert rows(dashboards.trend_by_day(amounts).where("day IS NULL"), "purchases", "revenue") == [(1, 50.0)]
    activity = {r.customer_id: r for r in dashboards.customer_activity(purchases, as_of=NOW).collect()}
    assert (activity["a"].purchases, activity["a"].active_days, activity["a"].days_since_last) == (4, 3, 22)
    items = spark.createDataFrame([(f"p{i}", float(i % 4), 1) for i in range(9)], "product_id string, total_price double, quantity int")
    assert [r.product_id for r in dashboards.top_products(items, 3).collect()] == ["p3", "p7", "p2"]


def test_quality(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "k string")
    out = quality.duplicate_ratio_alert({"full": (df, ["k"]), "half": (df.limit(0).union(spark.createDataFrame([("a",), ("a",)], "k string")), ["k"]), "empty": (df.limit(0), ["k"])})
    got = {r.table_name: (r.total_rows, r.distinct_keys, r.duplicate_ratio, r.alert) for r in out.collect()}
    assert got["full"] == (5, 2, pytest.approx(0.6), True)
    assert got["half"] == (2, 1, 0.5, False)  # not above one half
    assert got["empty"] == (0, 0, None, False)
    assert rows(quality.volume_totals({"x": df, "y": df.limit(0)})) == [("x", 5), ("y", 0)]


def test_orphans_and_reconcile(spark, purchases):
    known = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    out = quality.orphan_purchases(purchases, {"customer_id": known})
    assert rows(out) == [("o4", "customer_id"), ("o5", "customer_id")]
    items = spark.createDataFrame([("o1", 60.0), ("o1", 40.0), ("o3", 1.0)], "purchase_id string, total_price double")
    got = {r.purchase_id: (r.items_total, r.item_count, r.matches)
           for r in quality.basket_reconcile(purchases.where("purchase_id in ('o1', 'o3', 'o5')"), items).collect()}
    assert got == {"o1": (100.0, 2, True), "o3": (1.0, 1, False), "o5": (0.0, 0, False)}
