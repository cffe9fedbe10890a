"""Live panels: totals, stores, days and customers' days, kept by one streaming aggregate.

Batches append *changes*: a new purchase counts once, a purchase sent again takes back what it was and counts as what it is.
The stream copies every change once per panel (what SQL calls grouping sets) and keeps all panels in one state store, in
update mode: each micro-batch writes the groups it changed, late corrections included. Regions are looked up from the
stores when read, so they need no state of their own.

State holds one row per group: stores, days, and customers' days. There is no watermark, as a correction may come
at any time; the store is on disk and grows with these groups, not with purchases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.sinks.tables import compact_latest, latest_rows, write_batch
from tillflow.sources.tables import is_complete

CHANGES = "customer_id string, store_id string, day date, amount double, sign int"
PANELS = "panel string, key string, day date, purchases bigint, revenue double"
_KEYS = ["panel", "key", "day"]


def add_changes(filed: DataFrame, batch_id: int, root: str) -> None:
    """Append the changes of one batch of :func:`shelves.file_purchases`.

    Changes of a batch are the same whenever it runs, so a replay leaves files alone that the stream may have read.
    """
    if is_complete(filed.sparkSession, f"{root}/changes/batch_id={batch_id}"):
        return
    now = filed.select("customer_id", "store_id", F.to_date("purchase_datetime").alias("day"), F.col("total_amount").alias("amount"),
                       F.lit(1).alias("sign"))
    before = filed.where("resent").select(
        F.col("former").alias("customer_id"), "was.store_id", F.to_date("was.purchase_datetime").alias("day"),
        F.col("was.total_amount").alias("amount"), F.lit(-1).alias("sign"))
    write_batch(now.unionByName(before), f"{root}/changes", batch_id)


def read_changes(spark: SparkSession, root: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """The changes as a stream."""
    reader = spark.readStream.schema(CHANGES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{root}/changes")


def panel_groups(changes: DataFrame) -> DataFrame:
    """Purchases and revenue per panel and group, of a stream or a table of changes."""
    nobody, never = F.lit(None).cast("string"), F.lit(None).cast("date")

    def group(panel: str, key, day):
        return F.struct(F.lit(panel).alias("panel"), key.alias("key"), day.alias("day"))

    sets = F.array(group("total", nobody, never), group("store", F.col("store_id"), never), group("day", nobody, F.col("day")),
                   group("customer", F.col("customer_id"), F.col("day")))
    each = changes.select(F.inline(sets), "sign", "amount")
    return each.groupBy(*_KEYS).agg(
        F.sum("sign").alias("purchases"), F.sum(F.col("sign") * F.col("amount")).alias("revenue"))


def start_panels(changes: DataFrame, root: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Write the groups each micro-batch changes, up to the end of what there is now; with ``every`` go on until stopped."""
    return (
        panel_groups(changes).writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, f"{root}/panels/batches", batch_id) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def compact_panels(spark: SparkSession, root: str) -> str | None:
    """Fold the updates so far into one version with one row per group."""
    return compact_latest(spark, f"{root}/panels", PANELS, _KEYS)


def _groups(spark: SparkSession, root: str, panel: str) -> DataFrame:
    # A group whose purchases all moved elsewhere is empty again.
    rows = latest_rows(spark, f"{root}/panels", PANELS, _KEYS)
    return rows.where((F.col("panel") == panel) & (F.col("purchases") > 0))


def live_totals(spark: SparkSession, root: str) -> DataFrame:
    return _groups(spark, root, "total").select("purchases", "revenue")


def live_stores(spark: SparkSession, root: str) -> DataFrame:
    return _groups(spark, root, "store").select(F.col("key").alias("store_id"), "purchases", "revenue")


def live_regions(spark: SparkSession, root: str, stores: DataFrame, region: str = "city") -> DataFrame:
    """Purchases, revenue and active stores per region column of the store table."""
    named = live_stores(spark, root).join(stores.select("store_id", region), "store_id", "left")
    return named.groupBy(region).agg(F.sum("purchases").alias("purchases"), F.sum("revenue").alias("revenue"),
                                     F.count("store_id").alias("active_stores"))


def live_days(spark: SparkSession, root: str) -> DataFrame:
    return _groups(spark, root, "day").select("day", "purchases", "revenue")


def live_activity(spark: SparkSession, root: str) -> DataFrame:
    """Purchases, active days and the last day per customer."""
    return _groups(spark, root, "customer").groupBy(F.col("key").alias("customer_id")).agg(
        F.sum("purchases").alias("purchases"), F.count("day").alias("active_days"), F.max("day").alias("last_day"))
