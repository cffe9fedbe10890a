"""The mart as mergeable aggregate states: a batch adds states and does not read the purchases before it.

One state row sums up purchases of one cell (customer and slice) and store group: counts, sum, extremes, and the numbers of the
stores. States of new purchases are simply added. A purchase that is sent again, changed or under another customer, cannot be
taken out of an extreme or a set; the cells it was and is in are computed anew from their buckets of the shelf, and
the new rows replace all earlier states of the cell. Reading merges what is left.

Stores get numbers as they first appear, dense within each of ``GROUPS`` groups, so sets are exact and short: most cells know
a few stores, of which a bitmap would keep 4 KB a row. A group is cut into chunks of numbers, so no set is longer than a chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.functions.clock import AsOf
from tillflow.operators.dedup import keep_latest
from tillflow.operators.mart import customer_records, payment_counts, registered_lately
from tillflow.schemas import MART_COLUMNS
from tillflow.sinks.tables import latest_version, publish_version, read_batches, read_versioned, write_batch
from tillflow.streaming import shelves
from tillflow.streaming.ingest import current

GROUPS = 16
# Rows of purchases or states that one task sorts and sums up; what it needs for them does not grow with the tables.
TASK_ROWS = 500_000

STORES = "store_id string, store_group int, place bigint"
STATES = ("customer_id string, slice int, store_group int, chunk bigint, replaces boolean, purchases bigint, spent double, "
          "first_purchase timestamp, last_purchase timestamp, cash_count bigint, card_count bigint, delivery_count bigint, "
          "stores array<int>")
_SUMS = ("purchases", "spent", "cash_count", "card_count", "delivery_count")
_CELL = ["customer_id", "slice"]


def _number_stores(spark: SparkSession, batch_id: int, root: str, filed: DataFrame) -> DataFrame:
    """All stores known after the batch with their numbers; those of earlier batches stay as they are."""
    known = read_batches(spark, f"{root}/states/stores", STORES).where(F.col("batch_id") < batch_id).drop("batch_id")
    group = F.pmod(F.xxhash64("store_id"), F.lit(GROUPS)).cast("int")
    new = filed.where("store_id IS NOT NULL").select("store_id").distinct().join(known, "store_id", "left_anti").withColumn(
        "store_group", group)
    used = known.groupBy("store_group").agg(F.count("*").alias("used"))
    rank = F.row_number().over(Window.partitionBy("store_group").orderBy("store_id"))
    numbered = new.withColumn("rank", rank).join(used, "store_group", "left").select(
        "store_id", "store_group", (F.coalesce("used", F.lit(0)) + F.col("rank") - 1).alias("place"))
    path = write_batch(numbered, f"{root}/states/stores", batch_id)
    return known.unionByName(spark.read.schema(STORES).parquet(path))


def _spread(rows: DataFrame, count: int, *keys: str) -> DataFrame:
    """The rows dealt out by the keys to as many tasks as ``count`` rows need."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // TASK_ROWS)), *keys)


def _states(purchases: DataFrame, stores: DataFrame) -> DataFrame:
    """State rows of purchases (with ``replaces``): one per cell, group of stores and chunk of their numbers."""
    numbered = purchases.join(stores, "store_id", "left")
    amount = F.when(~F.isnan("total_amount"), F.col("total_amount"))
    return numbered.groupBy(*_CELL, "store_group", F.bitmap_bucket_number("place").alias("chunk"), "replaces").agg(
        F.count("purchase_id").alias("purchases"), F.sum(F.coalesce(amount, F.lit(0.0))).alias("spent"),
        F.min("purchase_datetime").alias("first_purchase"), F.max("purchase_datetime").alias("last_purchase"),
        *payment_counts(F.lower("payment_method")), F.sum(F.coalesce("is_delivery", F.lit(0))).cast("long").alias("delivery_count"),
        F.collect_set(F.bitmap_bit_position("place").cast("int")).alias("stores"))


def add_states(spark: SparkSession, batch_id: int, root: str, buckets: int = shelves.BUCKETS) -> str:
    """Append the states of one batch, which :mod:`ingest` has landed; a replay replaces them."""
    filed = shelves.file_purchases(spark, batch_id, root, buckets)
    stores = _number_stores(spark, batch_id, root, filed)
    resent = filed.where("resent")
    cells = resent.select(*_CELL).unionByName(resent.select(F.col("former").alias("customer_id"), "slice")).dropna().distinct()
    stored = write_batch(cells, f"{root}/states/changed", batch_id)
    changed = spark.read.schema("customer_id string, slice int").parquet(stored)
    n = changed.count()

    columns = [*_CELL, "purchase_id", "store_id", "total_amount", "payment_method", "is_delivery", "purchase_datetime", "replaces"]
    added = filed.where("customer_id IS NOT NULL").join(shelves.sized(changed, n), _CELL, "left_anti").withColumn("replaces", F.lit(False))
    again = shelves.purchases_in(spark, root, changed, batch_id, buckets).withColumn("replaces", F.lit(True))
    # A cell that lost its last purchase has nothing to sum up; the bare row makes its earlier states void.
    void = changed.withColumn("replaces", F.lit(True))
    # As many purchases again as the batch has, about: the rows of a changed cell are few.
    purchases = _spread(added.select(*columns).unionByName(again.select(*columns)), 2 * filed.count(), *_CELL)
    states = _states(purchases, stores).unionByName(void, allowMissingColumns=True)
    return write_batch(states, f"{root}/states/batches", batch_id)


def _live(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The states that count: of each cell, the rows since it was last replaced; and how many rows there are at most."""
    rows = read_versioned(spark, f"{root}/states", STATES)
    n = rows.count()
    since = F.max(F.when(F.col("replaces"), F.col("batch_id"))).over(Window.partitionBy(*_CELL))
    live = _spread(rows, n, *_CELL).withColumn("since", since).where("since IS NULL OR batch_id >= since").drop("since")
    return live.where("purchases IS NOT NULL"), n


def _by_store(rows: DataFrame, by: list[str]) -> DataFrame:
    """The totals of the groups, one row per store of each (``at``; NULL without one): added up, they are the group's."""
    once = F.coalesce("nth", F.lit(0)) == 0  # a state's own totals go with the first of its stores
    values = ["first_purchase", "last_purchase", *_SUMS]
    each = rows.select("*", F.posexplode_outer("stores").alias("nth", "at")).select(
        *by, "at", *[F.when(once, F.col(c)).alias(c) for c in values])
    return each.groupBy(*by, "at").agg(*_totals())


def _totals() -> list:
    return [F.min("first_purchase").alias("first_purchase"), F.max("last_purchase").alias("last_purchase"),
            *[F.sum(c).alias(c) for c in _SUMS]]


def mart_totals(spark: SparkSession, root: str) -> DataFrame:
    """Per customer: the totals of the mart, merged from states alone."""
    live, n = _live(spark, root)
    by = ["customer_id", "store_group", "chunk"]
    stores = _by_store(_spread(live, n, "customer_id", "store_group"), by)
    return stores.groupBy("customer_id").agg(*_totals(), F.count("at").alias("distinct_stores")).select(
        "customer_id", F.col("purchases").alias("purchase_count"), F.col("spent").alias("total_spent"),
        (F.col("spent") / F.col("purchases")).alias("avg_basket"), "first_purchase", "last_purchase", "distinct_stores",
        "cash_count", "card_count", "delivery_count")


def mart_from_states(spark: SparkSession, root: str, *, as_of: AsOf = None) -> DataFrame:
    """The mart of everything landed so far; who is new is judged when it is read."""
    who = customer_records(current(spark, root, "customers"))
    # Both sides are dealt out by customer already.
    joined = mart_totals(spark, root).join(who.hint("merge"), "customer_id", "left")
    return joined.select(
        *[c for c in MART_COLUMNS if c in joined.columns and c not in ("is_loyalty_member", "registration_date")],
        F.when(registered_lately(joined, as_of), 1).otherwise(0).alias("new_customer"),
        F.coalesce("is_loyalty_member", F.lit(0)).alias("is_loyalty_member"), "registration_date").select(*MART_COLUMNS)


def compact_states(spark: SparkSession, root: str) -> str | None:
    """Fold all states so far into one row per cell, store group and chunk; later reads merge only newer batches with it."""
    newest = read_batches(spark, f"{root}/states/batches", STATES).agg(F.max("batch_id")).first()[0]
    if newest is None or f"{newest:020d}" == latest_version(spark, f"{root}/states/compact"):
        return None
    by = [*_CELL, "store_group", "chunk"]
    rows = _by_store(_live(spark, root)[0].where(F.col("batch_id") <= newest), by).groupBy(*by).agg(
        *_totals(), F.collect_list("at").alias("stores"))
    folded = rows.withColumns({"replaces": F.lit(False), "batch_id": F.lit(newest)})
    return publish_version(folded, f"{root}/states/compact", f"{newest:020d}", sort_by=["customer_id"])
