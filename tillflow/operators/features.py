"""Customer-behaviour features.

``distinct products of a category > 0`` only asks whether such a product occurs, so each category
flag is a ``max`` over the lines: one partial aggregate and one shuffle, instead of one copy of
every line per distinct count. Money is aggregated per purchase, before lines multiply it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.clock import AsOf, as_of_like, days_before, start_of_day

# Category labels of the source documents, lower-cased, and the group each means.
CATEGORY_GROUPS = {
    "🥖🥖 зерновые и хлебобулочные изделия": "bakery",
    "🥩🥩 мясо, рыба, яйца и бобовые": "meat",
    "🥛🥛 молочные продукты": "milk",
    "🍏🍏 фрукты и ягоды": "fruits",
    "🥦🥦 овощи и зелень": "veggies",
}


@dataclass(frozen=True)
class CategoryFlag:
    """``name`` is true when the customer bought ``category`` (within ``days``, if windowed).

    ``negate`` turns it into "did not buy".
    """

    name: str
    category: str
    days: int | None = None
    negate: bool = False


CATEGORY_FLAGS = (
    CategoryFlag("bought_milk_last_30d", "milk", 30),
    CategoryFlag("bought_fruits_last_14d", "fruits", 14),
    CategoryFlag("not_bought_veggies_14d", "veggies", 14, negate=True),
    CategoryFlag("buys_bakery", "bakery"),
)

VEGETARIAN = CategoryFlag("vegetarian_profile", "meat", negate=True)


def category_group(c: Column, groups: dict[str, str] = CATEGORY_GROUPS) -> Column:
    """Group of a category label, in any case; a label that is not listed stays as it is."""
    label = F.lower(c)
    table = F.create_map(*[F.lit(v) for pair in groups.items() for v in pair])
    return F.coalesce(F.try_element_at(table, label), label)


def _bought(flag: CategoryFlag, lines: DataFrame, as_of: AsOf, windowed: bool) -> Column:
    hit = (F.col("category") == flag.category) & F.col("product_id").isNotNull()
    if windowed and flag.days is not None:
        now = as_of_like(lines, "purchase_datetime", as_of)
        hit = hit & (F.col("purchase_datetime") >= days_before(now, flag.days)) & (F.col("purchase_datetime") <= now)
    return F.max(F.coalesce(hit, F.lit(False)))


def category_flags(lines: DataFrame, flags: Sequence[CategoryFlag] = CATEGORY_FLAGS, *,
                   as_of: AsOf = None, windowed: bool = False) -> DataFrame:
    """Flags per customer from lines with ``customer_id, product_id, category, purchase_datetime``."""
    return lines.groupBy("customer_id").agg(
        *[
            (~_bought(f, lines, as_of, windowed) if f.negate else _bought(f, lines, as_of, windowed)).alias(f.name)
            for f in flags
        ]
    )


def purchase_features(purchases: DataFrame, *, as_of: AsOf = None, bulk_above: float = 1000,
                      low_below: float = 200, recurrent_above: int = 2, idle_days: int = 30,
                      windowed: bool = False, unique_purchases: bool = False) -> DataFrame:
    """Features that need purchases only.

    ``windowed``: ``inactive_30d`` tests the last purchase, as its name says; otherwise the first.
    ``unique_purchases``: the key is known to be unique, so a plain count replaces the distinct one.
    """
    now = as_of_like(purchases, "purchase_datetime", as_of)
    today = start_of_day(now).cast(purchases.schema["purchase_datetime"].dataType)
    purchase_count = F.count("purchase_id") if unique_purchases else F.count_distinct("purchase_id")
    reference = F.max("purchase_datetime") if windowed else F.min("purchase_datetime")
    return purchases.groupBy("customer_id").agg(
        (purchase_count > recurrent_above).alias("recurrent_buyer"),
        (F.avg("total_amount") > bulk_above).alias("bulk_buyer"),
        (F.avg("total_amount") < low_below).alias("low_cost_buyer"),
        (F.max("purchase_datetime") > today).alias("active_today"),
        (reference < days_before(today, idle_days)).alias("inactive_30d"),
    )


def customer_features(purchases: DataFrame, lines: DataFrame, *, as_of: AsOf = None,
                      flags: Sequence[CategoryFlag] = CATEGORY_FLAGS, windowed: bool = False,
                      item_weighted: bool = False, **thresholds) -> DataFrame:
    """All features, one row per buyer. Both sides end up keyed by customer, so the join adds no shuffle.

    ``item_weighted`` averages the purchase total over lines (a purchase counts once per line);
    ``lines`` must then hold every purchase at least once and carry ``total_amount``.
    """
    base = purchase_features(purchases, as_of=as_of, windowed=windowed, **thresholds)
    if item_weighted:
        money = lines.groupBy("customer_id").agg(
            (F.avg("total_amount") > thresholds.get("bulk_above", 1000)).alias("bulk_buyer"),
            (F.avg("total_amount") < thresholds.get("low_below", 200)).alias("low_cost_buyer"),
        )
        base = base.drop("bulk_buyer", "low_cost_buyer").join(money, "customer_id", "left")
    bought = category_flags(lines, flags, as_of=as_of, windowed=windowed)
    joined = base.join(bought, "customer_id", "left")
    return joined.withColumns({f.name: F.coalesce(F.col(f.name), F.lit(f.negate)) for f in flags})


def features_of_lines(lines: DataFrame, *, first: str, as_of: AsOf = None, flags: Sequence[CategoryFlag] = CATEGORY_FLAGS,
                      bulk_above: float = 1000, low_below: float = 200, recurrent_above: int = 2, idle_days: int = 30,
                      windowed: bool = False) -> DataFrame:
    """The same features from lines alone, in one aggregate: ``first`` is true on one line of each purchase.

    Every purchase, also one without items, must have such a line; purchase ids must be unique.
    """
    now = as_of_like(lines, "purchase_datetime", as_of)
    today = start_of_day(now).cast(lines.schema["purchase_datetime"].dataType)
    header, at = F.col(first), F.col("purchase_datetime")
    amount = F.avg(F.when(header, F.col("total_amount")))
    reference = F.max(at) if windowed else F.min(at)
    bought = [~_bought(f, lines, as_of, windowed) if f.negate else _bought(f, lines, as_of, windowed) for f in flags]
    out = lines.groupBy("customer_id").agg(
        (F.count_if(header & F.col("purchase_id").isNotNull()) > recurrent_above).alias("recurrent_buyer"),
        (amount > bulk_above).alias("bulk_buyer"), (amount < low_below).alias("low_cost_buyer"),
        (F.max(at) > today).alias("active_today"), (reference < days_before(today, idle_days)).alias("inactive_30d"),
        *[b.alias(f.name) for b, f in zip(bought, flags, strict=True)])
    # As in the join of the two sides, what unknown buyers bought is nobody's.
    known = F.col("customer_id").isNotNull()
    return out.withColumns({f.name: F.when(known, F.col(f.name)).otherwise(F.lit(f.negate)) for f in flags})


def features_at(purchases: DataFrame, lines: DataFrame, dates: Sequence[str], *, flags: Sequence[CategoryFlag] = CATEGORY_FLAGS,
                bulk_above: float = 1000, low_below: float = 200, recurrent_above: int = 2, idle_days: int = 30) -> DataFrame:
    """The windowed features as of many dates in one pass: one row per date and buyer with a purchase by then.

    Equal to :func:`customer_features` over the rows up to each date, with ``windowed`` and unique purchase ids. Purchases and lines
    become a timeline per customer, on which each date is a row as well; range frames sum up what lies before it.
    Where all dates are midnights, a customer's rows of a day are first summed up to two, those of midnight itself and the
    others, so a hot customer's timeline grows with the days and not with the rows.
    """
    kind = purchases.schema["purchase_datetime"].dataType
    at = F.col("purchase_datetime")
    moments = F.array(*[F.lit(d).cast("timestamp_ntz").cast(kind) for d in dates])
    midnight = F.date_trunc("day", at).cast(kind)
    by_days = all(len(d) == 10 or d[11:] in ("00:00", "00:00:00") for d in dates)
    when = F.when(at == midnight, at).otherwise(midnight + F.expr("INTERVAL 12 HOURS")) if by_days else at
    header = purchases.select("customer_id", when.alias("at"), at.alias("bought"), F.lit(1).alias("n"), "total_amount")
    hits = [((F.col("category") == f.category) & F.col("product_id").isNotNull()).alias(f.name) for f in flags]
    # As in the join of the two sides, lines of unknown buyers are nobody's.
    sold = lines.where("customer_id IS NOT NULL").select("customer_id", when.alias("at"), *hits)
    events = header.unionByName(sold, allowMissingColumns=True).where("at IS NOT NULL").groupBy("customer_id", "at").agg(
        F.sum("n").alias("n"), F.sum("total_amount").alias("total"), F.count("total_amount").alias("amounts"),
        F.max("bought").alias("last"), *[F.max(f.name).alias(f.name) for f in flags])
    asked = events.select("customer_id").distinct().withColumn("as_of", F.explode(moments)).withColumn("at", F.col("as_of"))
    timeline = events.unionByName(asked, allowMissingColumns=True)

    def upto(what: str, days: int | None = None) -> Column:
        start = "UNBOUNDED" if days is None else f"INTERVAL {int(days)} DAYS"
        return F.expr(f"{what} OVER (PARTITION BY customer_id ORDER BY at RANGE BETWEEN {start} PRECEDING AND CURRENT ROW)")

    seen = timeline.select(
        "customer_id", "as_of", upto("sum(n)").alias("n"), upto("sum(total)").alias("total"), upto("sum(amounts)").alias("amounts"),
        upto("max(last)").alias("last"), *[F.coalesce(upto(f"max(`{f.name}`)", f.days), F.lit(False)).alias(f.name) for f in flags])
    mean = F.try_divide("total", "amounts")
    today = F.date_trunc("day", F.col("as_of")).cast(kind)
    return seen.where("as_of IS NOT NULL AND n > 0").select(
        "customer_id", "as_of", (F.col("n") > recurrent_above).alias("recurrent_buyer"), (mean > bulk_above).alias("bulk_buyer"),
        (mean < low_below).alias("low_cost_buyer"), (F.col("last") > today).alias("active_today"),
        (F.col("last") < today - F.expr(f"INTERVAL {int(idle_days)} DAYS")).alias("inactive_30d"),
        *[(~F.col(f.name) if f.negate else F.col(f.name)).alias(f.name) for f in flags])


def with_profile(features: DataFrame, mart: DataFrame) -> DataFrame:
    """Add the mart's ``new_customer`` and ``is_loyalty_member`` to the features."""
    return features.join(mart.select("customer_id", "new_customer", "is_loyalty_member"), "customer_id", "left")
