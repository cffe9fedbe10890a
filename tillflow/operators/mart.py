"""Customer mart: one row per buyer, in the two definitions in use.

``customer_mart``      tolerant: amounts that do not parse count as 0, buyers without an id are
                       left out, at most one customer row is matched.
``customer_mart_sql``  plain SQL semantics: NULL amounts are skipped, a NULL id is a group, and
                       repeated customer rows repeat the result row.

Purchases are aggregated before the join, so the join sees one row per customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions import lenient
from tillflow.functions.clock import AsOf, as_of_like, days_before, start_of_day
from tillflow.operators.dedup import keep_first
from tillflow.operators.joins import fan_out_left_join
from tillflow.schemas import MART_COLUMNS

NEW_CUSTOMER_DAYS = 30


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add the columns that are absent, so a narrower table can still be aggregated."""
    missing = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def _instant(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return lenient.to_instant(F.col(column))
    return F.col(column)


def _purchases_ready(purchases: DataFrame) -> DataFrame:
    """Coerced columns the tolerant definition aggregates, and no others."""
    df = with_defaults(
        purchases,
        {
            "purchase_datetime": F.lit(None).cast("timestamp"),
            "total_amount": F.lit(0.0),
            "is_delivery": F.lit(0),
            "payment_method": F.lit(""),
        },
    )
    amount = F.col("total_amount")
    if not isinstance(df.schema["total_amount"].dataType, T.DoubleType):
        amount = amount.try_cast("double")
    amount = F.when(~F.isnan(amount), amount)
    return df.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "purchase_id",
        "store_id",
        F.coalesce(amount, F.lit(0.0)).alias("total_amount"),
        F.lower(F.col("payment_method").cast("string")).alias("payment_method"),
        F.coalesce(F.col("is_delivery").cast("int"), F.lit(0)).alias("is_delivery"),
        _instant(df, "purchase_datetime").alias("purchase_datetime"),
    )


def payment_counts(method: Column) -> list[Column]:
    """Conditional counts of purchases paid in cash and by card."""
    return [
        F.count_if(method == "cash").alias("cash_count"),
        F.count_if(method == "card").alias("card_count"),
    ]


def customer_totals(purchases: DataFrame, *, count: Column | None = None) -> DataFrame:
    """Per-customer aggregates of columns that already have their final types.

    The distinct count is planned in steps: rows are first reduced to (customer, store) inside
    each task and shuffled on that pair, so a hot customer is split by store before its final row.
    """
    return purchases.groupBy("customer_id").agg(
        (F.count(F.lit(1)) if count is None else count).alias("purchase_count"),
        F.sum("total_amount").alias("total_spent"),
        F.avg("total_amount").alias("avg_basket"),
        F.min("purchase_datetime").alias("first_purchase"),
        F.max("purchase_datetime").alias("last_purchase"),
        F.count_distinct("store_id").alias("distinct_stores"),
        *payment_counts(F.col("payment_method")),
        F.sum("is_delivery").cast("bigint").alias("delivery_count"),
    )


def _loyalty(df: DataFrame) -> Column:
    flag = F.col("is_loyalty_member")
    if isinstance(df.schema["is_loyalty_member"].dataType, T.StringType):
        flag = flag.try_cast("double")
    return F.coalesce(flag.cast("int"), F.lit(0)).alias("is_loyalty_member")


def customer_records(customers: DataFrame) -> DataFrame:
    """What the mart takes from customers: id, registration and loyalty flag, in their types."""
    df = with_defaults(
        customers,
        {"registration_date": F.lit(None).cast("timestamp"), "is_loyalty_member": F.lit(0)},
    )
    return df.select("customer_id", _instant(df, "registration_date").alias("registration_date"), _loyalty(df))


def registered_lately(df: DataFrame, as_of: AsOf) -> Column:
    """Registered less than 30 whole days of 24 h before ``as_of``; a later date counts as well."""
    return F.col("registration_date") > days_before(as_of_like(df, "registration_date", as_of), NEW_CUSTOMER_DAYS)


def customer_agg(purchases: DataFrame) -> DataFrame:
    """The purchase side of the tolerant mart."""
    return customer_totals(_purchases_ready(purchases), count=F.count("purchase_id"))


def _finish(totals: DataFrame, joined: DataFrame, is_new: Column) -> DataFrame:
    return joined.select(
        *totals.columns,
        F.when(is_new, 1).otherwise(0).alias("new_customer"),
        F.coalesce("is_loyalty_member", F.lit(0)).cast("int").alias("is_loyalty_member"),
        "registration_date",
    ).select(*MART_COLUMNS)


def customer_mart(purchases: DataFrame, customers: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Tolerant definition; new means registered less than 30 whole days of 24 h before ``as_of``."""
    totals = customer_agg(purchases)
    known = keep_first(customer_records(customers), ["customer_id"], ["registration_date"])
    joined = totals.join(known, ["customer_id"], "left")
    return _finish(totals, joined, registered_lately(known, as_of))


def customer_mart_sql(purchases: DataFrame, customers: DataFrame, *, as_of: AsOf = None,
                      hot: DataFrame | None = None) -> DataFrame:
    """SQL definition; new means registered fewer than 30 calendar days before ``as_of``.

    ``hot``: customers repeated so often that one task could not hold their rows, see ``joins.hot_keys``.
    """
    totals = customer_totals(purchases)
    known = customers.select("customer_id", "registration_date", "is_loyalty_member")
    joined = (totals.join(known, "customer_id", "left") if hot is None
              else fan_out_left_join(totals, known, ["customer_id"], hot=hot))
    today = start_of_day(as_of_like(known, "registration_date", as_of))
    is_new = F.datediff(today, F.to_date("registration_date")) < NEW_CUSTOMER_DAYS
    return _finish(totals, joined, is_new)
