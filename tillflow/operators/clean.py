"""Typed → clean: lower-casing, validity rules, duplicates; and a report on what the rules reject."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.clock import AsOf, as_of_like
from tillflow.functions.lenient import blank_to_null
from tillflow.operators.dedup import distinct_rows, drop_blank_keys, keep_latest
from tillflow.schemas import KEYS


@dataclass(frozen=True)
class _Rules:
    lowered: tuple[str, ...]
    not_after: tuple[str, ...] = ()      # columns that must not lie after ``as_of``
    not_negative: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    as_timestamp: tuple[str, ...] = ()


# Which columns each clean table lowers, checks, drops or widens.
RULES = {
    "customers": _Rules(
        lowered=("first_name", "last_name", "gender"),
        not_after=("birth_date", "registration_date"),
    ),
    "products": _Rules(
        lowered=("name", "category", "description", "unit", "origin_country",
                 "manufacturer_name", "manufacturer_country"),
        not_negative=("price",),
    ),
    "stores": _Rules(
        lowered=("store_name", "store_network", "city", "street", "manager_name"),
        dropped=("store_type_description", "type"),
        as_timestamp=("last_inventory_date",),
    ),
    "purchases": _Rules(
        lowered=("payment_method",),
        not_after=("purchase_datetime",),
        not_negative=("total_amount",),
    ),
}


def _checks(typed: DataFrame, entity: str, as_of: AsOf) -> list[tuple[str, Column]]:
    """(reason, what a row must satisfy) in the order in which reasons are reported."""
    rules = RULES[entity]
    checks = [("blank_key", blank_to_null(F.col(KEYS[entity]).cast("string")).isNotNull())]
    for c in rules.not_after:
        checks.append((f"{c}_missing_or_future", F.col(c) <= as_of_like(typed, c, as_of)))
    for c in rules.not_negative:
        checks.append((f"{c}_missing_or_negative", F.col(c) >= 0))
    return checks


def clean(typed: DataFrame, entity: str, *, as_of: AsOf = None, duplicates: str = "latest",
          order_by: tuple[str, ...] = ("ins_ts",)) -> DataFrame:
    """Clean table of one entity.

    ``duplicates``: ``latest`` keeps one row per key, ``exact`` drops only identical rows,
    ``keep`` drops none (for streams, whose duplicates are resolved when the table is read).
    A NULL in a checked column drops the row, as a comparison with NULL is not true.
    """
    rules = RULES[entity]
    df = typed
    for _, must in _checks(typed, entity, as_of)[1:]:
        df = df.where(must)
    df = drop_blank_keys(df, [KEYS[entity]])
    df = df.withColumns({c: F.lower(c) for c in rules.lowered})
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in rules.as_timestamp}) if rules.as_timestamp else df
    df = df.drop(*rules.dropped)
    if duplicates == "latest":
        return keep_latest(df, [KEYS[entity]], order_by)
    if duplicates == "exact":
        return distinct_rows(df)
    if duplicates == "keep":
        return df
    raise ValueError(f"duplicates must be latest, exact or keep, not {duplicates!r}")


def clean_customers(typed: DataFrame, **options) -> DataFrame:
    return clean(typed, "customers", **options)


def clean_products(typed: DataFrame, **options) -> DataFrame:
    return clean(typed, "products", **options)


def clean_stores(typed: DataFrame, **options) -> DataFrame:
    return clean(typed, "stores", **options)


def clean_purchases(typed: DataFrame, **options) -> DataFrame:
    return clean(typed, "purchases", **options)


def rejected_rows(typed: DataFrame, entity: str, *, as_of: AsOf = None) -> DataFrame:
    """Rows :func:`clean` leaves out, with the first rule they break in ``reason``."""
    reason = None
    for name, must in _checks(typed, entity, as_of):
        broken = ~F.coalesce(must, F.lit(False))
        reason = F.when(broken, name) if reason is None else reason.when(broken, name)
    return typed.withColumn("reason", reason).where(F.col("reason").isNotNull())


def rejects_by_reason(typed: DataFrame, entity: str, *, as_of: AsOf = None) -> DataFrame:
    return (
        rejected_rows(typed, entity, as_of=as_of)
        .groupBy(F.lit(entity).alias("entity"), "reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
