"""Golden values of the sample documents (FIXTURES.md §3), where a folder with them is given.

    SAMPLE_DOCS=<folder with customers/ products/ stores/ purchases/> python -m pytest tests/test_sample.py
"""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators import clean as cleaning
from tillflow.operators import dashboards, mart, quality
from tillflow.operators import features as feat
from tillflow.operators.items import enrich_items, explode_items
from tillflow.operators.parse import parse, quarantine
from tillflow.plans import jobs
from tillflow.plans.jobs import feature_table
from tillflow.schemas import ENTITIES

SAMPLE = os.environ.get("SAMPLE_DOCS", "")
AS_OF = "2025-09-25 00:00:00"

pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="SAMPLE_DOCS is not set")


@pytest.fixture(scope="module")
def raw(spark):
    parts = [jobs.masked_messages(spark, SAMPLE, e, "key") for e in ENTITIES]
    messages = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    return messages.select(
        F.lit(AS_OF).cast("timestamp").alias("ts"), F.col("topic").alias("source"), F.col("value").alias("raw_json")).cache()


@pytest.fixture(scope="module")
def clean(raw):
    return {e: cleaning.clean(parse(raw, e), e, as_of=AS_OF).cache() for e in ENTITIES}


def test_volumes(raw, clean):
    assert quarantine(raw).count() == 0
    assert {e: df.count() for e, df in clean.items()} == {"customers": 45, "products": 20, "stores": 45, "purchases": 200}
    alert = quality.duplicate_ratio_alert({e: (df, [df.columns[0]]) for e, df in clean.items()})
    assert alert.where("alert OR duplicate_ratio > 0").count() == 0


def test_purchases(clean):
    p = clean["purchases"]
    low, high, total = p.agg(F.min("total_amount"), F.max("total_amount"), F.round(F.sum("total_amount"), 2)).first()
    assert (low, high, total) == (54.10, 2735.05, 199494.15)
    days = dashboards.trend_by_day(p)
    assert days.count() == 82
    busiest = days.orderBy(F.desc("purchases"), F.desc("revenue")).first()
    assert (str(busiest.day), busiest.purchases, round(busiest.revenue, 2)) == ("2025-07-05", 7, 7186.89)


def test_items(clean):
    items = explode_items(clean["purchases"])
    assert items.count() == 392
    assert [(r.product_id, round(r.revenue, 2), r.units) for r in dashboards.top_products(items, 3).collect()] == [
        ("prd-1012", 16024.20, 68), ("prd-1003", 15228.69, 57), ("prd-1006", 14966.10, 54)]
    assert quality.basket_reconcile(clean["purchases"], items).where("NOT matches").count() == 0
    enriched = enrich_items(items, clean["products"])
    assert enriched.where("category IS NULL").count() == 0


def test_marts(clean):
    for build in (mart.customer_mart, mart.customer_mart_sql):
        out = build(clean["purchases"], clean["customers"], as_of=AS_OF)
        assert out.agg(F.sum("purchase_count"), F.sum("cash_count"), F.sum("card_count"), F.sum("delivery_count"),
                       F.count("*")).first()[:] == (200, 104, 96, 91, 45)
        picked = out.where("customer_id IN ('cus-1000', 'cus-1001', 'cus-1002')").select(
            "customer_id", "purchase_count", F.round("total_spent", 2), F.round("avg_basket", 4), "distinct_stores",
            "cash_count", "card_count", "delivery_count")
        assert rows(picked) == [
            ("cus-1000", 6, 6989.08, 1164.8467, 6, 2, 4, 2), ("cus-1001", 3, 3419.73, 1139.91, 3, 3, 0, 1),
            ("cus-1002", 7, 8375.14, 1196.4486, 6, 5, 2, 3)]


def test_stores(clean):
    by_store = dashboards.revenue_by_store(clean["purchases"], clean["stores"])
    top = by_store.orderBy(F.desc("revenue")).limit(3).collect()
    assert [(r.store_id, round(r.revenue, 2), r.purchases) for r in top] == [
        ("store-008", 13716.58, 10), ("store-040", 10186.24, 8), ("store-032", 8267.25, 8)]
    assert by_store.count() == 42
    networks = dashboards.revenue_by_region(clean["purchases"], clean["stores"], "store_network")
    assert sorted((r.purchases, round(r.revenue, 2)) for r in networks.collect()) == [(66, 67987.41), (134, 131506.74)]


def test_features(clean):
    def count(column, **options):
        table = feature_table(clean["purchases"], clean["products"], as_of=AS_OF, vegetarian=True, **options)
        return table.where(column).count()

    assert [count(c) for c in ("buys_bakery", "bought_milk_last_30d", "bought_fruits_last_14d", "NOT not_bought_veggies_14d",
                               "vegetarian_profile")] == [40, 24, 26, 36, 5]
    assert [count(c, windowed=True) for c in ("bought_milk_last_30d", "bought_fruits_last_14d", "NOT not_bought_veggies_14d")] == [9, 6, 8]
    assert [count(c) for c in ("recurrent_buyer", "bulk_buyer", "low_cost_buyer")] == [36, 20, 0]
    labels = clean["products"].select(feat.category_group(F.col("category")).alias("g")).distinct()
    assert rows(labels) == [("bakery",), ("fruits",), ("meat",), ("milk",), ("veggies",)]
