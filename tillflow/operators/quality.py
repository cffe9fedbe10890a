"""Data quality: duplicate alert, volumes, references that lead nowhere, baskets that do not add up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


DUPLICATE_LIMIT = 0.5


def duplicate_ratio(name: str, df: DataFrame, keys: Sequence[str], limit: float = DUPLICATE_LIMIT) -> DataFrame:
    """Share of rows that repeat a key, and whether it is above ``limit``; NULL ratio for an empty table.

    Keys are counted in two steps, so copies collapse inside each task before they are shuffled.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count_if(whole).alias("distinct_keys")
    )
    ratio = F.when(F.col("total_rows") > 0, 1 - F.col("distinct_keys") / F.col("total_rows"))
    return counts.select(
        F.lit(name).alias("table_name"),
        "total_rows",
        "distinct_keys",
        ratio.alias("duplicate_ratio"),
        F.coalesce(ratio > limit, F.lit(False)).alias("alert"),
    )


def duplicate_ratio_alert(tables: dict[str, tuple[DataFrame, Sequence[str]]],
                          limit: float = DUPLICATE_LIMIT) -> DataFrame:
    """One row per table."""
    parts = [duplicate_ratio(name, df, keys, limit) for name, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def volume_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def orphans(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in ``known`` (NULL included)."""
    return df.join(known.select(key), key, "left_anti")


def orphan_purchases(purchases: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """``purchase_id, missing`` for each reference (column name → table) a purchase fails."""
    parts = [
        orphans(purchases.select("purchase_id", column), known, column).select(
            "purchase_id", F.lit(column).alias("missing")
        )
        for column, known in references.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def basket_reconcile(purchases: DataFrame, items: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Compare each purchase's total with the sum of its lines."""
    sums = items.groupBy("purchase_id").agg(
        F.sum("total_price").alias("items_total"), F.count(F.lit(1)).alias("item_count")
    )
    joined = purchases.select("purchase_id", "total_amount").join(sums, "purchase_id", "left")
    items_total = F.coalesce("items_total", F.lit(0.0))
    return joined.select(
        "purchase_id",
        "total_amount",
        items_total.alias("items_total"),
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        (F.col("total_amount") - items_total).alias("difference"),
        (F.abs(F.col("total_amount") - items_total) <= tolerance).alias("matches"),
    )
