"""Mart kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.clock import AsOf
from tillflow.operators.dedup import keep_latest
from tillflow.operators.mart import customer_mart, registered_lately
from tillflow.sinks.tables import compact_latest, latest_rows, read_batches, read_versioned, write_batch
from tillflow.streaming import shelves
from tillflow.streaming.ingest import CLEAN_SCHEMA

MART_SCHEMA = (
    "customer_id string, purchase_count bigint, total_spent double, avg_basket double, "
    "first_purchase timestamp, last_purchase timestamp, distinct_stores bigint, cash_count bigint, "
    "card_count bigint, delivery_count bigint, new_customer int, is_loyalty_member int, "
    "registration_date timestamp"
)


CUSTOMERS = "customer_id string, registration_date timestamp, is_loyalty_member int, ins_ts timestamp, bucket int"


def _file_customers(spark: SparkSession, batch_id: int, root: str, buckets: int) -> DataFrame:
    """Put the batch's customers into buckets of their id; returns them."""
    batch = read_batches(spark, f"{root}/clean/customers/batch_id={batch_id}", CLEAN_SCHEMA["customers"])
    rows = batch.select("customer_id", "registration_date", "is_loyalty_member", "ins_ts",
                        shelves.bucket_of(buckets, "customer_id").alias("bucket"))
    folder = f"{shelves.shelf(root, buckets)}/customers/batches"
    write_batch(rows.repartition("bucket"), folder, batch_id, ["bucket"])
    return rows


def refresh_affected(spark: SparkSession, batch_id: int, root: str, *, as_of: AsOf = None, buckets: int = shelves.BUCKETS) -> str:
    """Recompute the customers one batch touches and append their rows under its ``batch_id``.

    Touched are the customers it names and the former owners of purchases it sends again. Their purchases and records are
    read from their buckets; all other history stays unread. A customer left without purchases gets a row without counts.
    """
    filed = shelves.file_purchases(spark, batch_id, root, buckets)
    named = _file_customers(spark, batch_id, root, buckets)
    touched = filed.select("customer_id").unionByName(filed.select(F.col("former").alias("customer_id"))).unionByName(
        named.select("customer_id")).dropna().distinct()
    # Stored before use: it is needed several times, and its size is then known to the joins.
    stored = write_batch(touched, f"{root}/affected", batch_id)
    affected = spark.read.schema("customer_id string").parquet(stored)
    theirs = shelves.purchases_in(spark, root, shelves.all_slices(affected), batch_id, buckets)
    n = affected.count()
    wanted = affected.withColumn("bucket", shelves.bucket_of(buckets, "customer_id"))
    records = read_versioned(spark, f"{shelves.shelf(root, buckets)}/customers", CUSTOMERS, before=batch_id + 1)
    who = keep_latest(shelves.in_buckets_of(records, wanted).join(
        shelves.sized(wanted, n), ["bucket", "customer_id"], "left_semi"), ["customer_id"], ["ins_ts", "batch_id"])
    return write_batch(affected.join(customer_mart(theirs, shelves.sized(who, n), as_of=as_of), "customer_id", "left"), f"{root}/mart/batches", batch_id)


def current_mart(spark: SparkSession, root: str, *, as_of: AsOf = None) -> DataFrame:
    """The latest row of each customer; customers without purchases left are gone.

    Who is new changes with time alone, so that flag is judged when read, not when stored.
    """
    latest = latest_rows(spark, f"{root}/mart", MART_SCHEMA, ["customer_id"]).where(F.col("purchase_count").isNotNull())
    is_new = F.when(registered_lately(latest, as_of), 1).otherwise(0)
    return latest.withColumn("new_customer", is_new).drop("batch_id")


def compact_mart(spark: SparkSession, root: str) -> str | None:
    """Fold the refreshed rows so far into one version with one row per customer."""
    return compact_latest(spark, f"{root}/mart", MART_SCHEMA, ["customer_id"])
