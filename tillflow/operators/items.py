"""Purchase lines: from the items text of a purchase to one row per item, and item ⟕ product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.schemas import ITEM_ROW

_CARRIED = ("purchase_id", "customer_id", "store_id", "purchase_datetime", "total_amount")


def explode_items(purchases: DataFrame, *, keep_empty: bool = False,
                  carry: Sequence[str] = _CARRIED, first: str | None = None) -> DataFrame:
    """One row per item, with the purchase columns the later steps need, so no join back is needed.

    ``keep_empty`` keeps purchases without items as one row of NULL item columns. ``first`` names a flag that is true on one
    row of each purchase, so that its header can be counted once without another look at the purchases.
    """
    items = F.from_json("items_json", f"array<struct<{ITEM_ROW}>>")
    explode = F.posexplode_outer if keep_empty else F.posexplode
    carried = [c for c in carry if c in purchases.columns]
    flag = [(F.coalesce("place", F.lit(0)) == 0).alias(first)] if first else []
    return purchases.select(*carried, explode(items).alias("place", "item")).select(
        *carried, *flag,
        "item.product_id",
        F.col("item.name").alias("product_name"),
        F.col("item.category").alias("item_category"),
        "item.quantity",
        "item.unit",
        "item.price_per_unit",
        "item.total_price",
    )


def enrich_items(items: DataFrame, products: DataFrame, *, columns: Sequence[str] = ("category",)) -> DataFrame:
    """Items with the chosen product columns; an unknown product leaves them NULL."""
    return items.join(products.select("product_id", *columns), "product_id", "left")
