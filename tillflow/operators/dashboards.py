"""Dashboard panels. Each aggregates by key first; names are looked up on the small result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.clock import AsOf, as_of_like


def _by_store(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("total_amount").alias("revenue")
    )


def revenue_by_store(purchases: DataFrame, stores: DataFrame) -> DataFrame:
    """Purchases and revenue per store, with the store's name; unknown stores keep a NULL name."""
    return _by_store(purchases).join(stores.select("store_id", "store_name"), "store_id", "left")


def revenue_by_region(purchases: DataFrame, stores: DataFrame, region: str = "city") -> DataFrame:
    """Purchases, revenue and active stores per region column of the store table."""
    per_store = _by_store(purchases).join(stores.select("store_id", region), "store_id", "left")
    return per_store.groupBy(region).agg(
        F.sum("purchases").alias("purchases"),
        F.sum("revenue").alias("revenue"),
        F.count("store_id").alias("active_stores"),
    )


def top_products(items: DataFrame, n: int = 10) -> DataFrame:
    """Best-selling products by revenue, grouped by id as names repeat. Only ``n`` rows per task travel."""
    return (
        items.groupBy("product_id")
        .agg(F.sum("total_price").alias("revenue"), F.sum("quantity").alias("units"))
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
    )


def trend_by_day(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy(F.to_date("purchase_datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("total_amount").alias("revenue")
    )


def customer_activity(purchases: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Purchases, active days and days since the last purchase, per customer.

    Two steps, (customer, day) and then customer, keep a hot customer's rows split by day.
    """
    now = as_of_like(purchases, "purchase_datetime", as_of)
    per_day = purchases.groupBy("customer_id", F.to_date("purchase_datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_day.groupBy("customer_id").agg(
        F.sum("n").alias("purchases"),
        F.count("day").alias("active_days"),
        F.max("day").alias("last_day"),
        F.datediff(F.to_date(now), F.max("day")).alias("days_since_last"),
    )
