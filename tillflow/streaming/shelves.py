"""Delivered purchases kept in hash buckets, so that a batch reads only the buckets it touches.

Two tables below ``root/shelf-<buckets>``, both written batch by batch with the bucket as a partition column:

``owners``  every delivery of a purchase, in the bucket of its id. It tells a batch which of its purchases were delivered
            before, to whom and with what.
``held``    the purchases of each customer, in the bucket of the customer and the purchase's slice. A purchase that moved to
            another customer leaves a removal with the former one, so a customer's rows are complete in themselves.

A customer's purchases lie in ``SLICES`` slices, by a hash of the purchase id: a customer with a third of all purchases is
spread over that many buckets, and a change to one purchase concerns one slice. Bucket numbers are gathered on the driver to
prune partitions; there are at most ``buckets`` of them. Both numbers must stay the same for the life of a folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.dedup import keep_latest
from tillflow.sinks.tables import publish_version, read_batches, read_versioned, write_batch
from tillflow.streaming.ingest import CLEAN_SCHEMA

BUCKETS = 64
SLICES = 8

_PURCHASE = ("purchase_id string, customer_id string, store_id string, total_amount double, payment_method string, "
             "is_delivery int, purchase_datetime timestamp, ins_ts timestamp")
OWNERS = f"{_PURCHASE}, bucket int"
HELD = f"{_PURCHASE}, slice int, removed boolean, bucket int"
_WAS = "store_id string, total_amount double, purchase_datetime timestamp"
FILED = f"{_PURCHASE}, slice int, resent boolean, former string, was struct<{_WAS}>"

_LATEST = ("ins_ts", "batch_id")

# Rows of a join's side up to which Spark may send it to every task.
FEW_KEYS = 100_000


def slice_of(purchase_id: str = "purchase_id") -> Column:
    return F.pmod(F.xxhash64(purchase_id), F.lit(SLICES)).cast("int")


def bucket_of(buckets: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def shelf(root: str, buckets: int) -> str:
    return f"{root}/shelf-{buckets}"


def in_buckets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of the buckets (column ``bucket``) that ``wanted`` names, as a filter on the partition column."""
    numbers = sorted(r.bucket for r in wanted.select("bucket").distinct().collect())
    return rows.where(F.col("bucket").isin(numbers)) if numbers else rows.where(F.lit(False))


def sized(side: DataFrame, rows: int) -> DataFrame:
    """A join's side of at most so many rows, sent to every task only where they are few.

    Spark judges a stored table by its compressed files, which are a small part of what its rows take on the driver.
    """
    return side if rows <= FEW_KEYS else side.hint("merge")


def _put(df: DataFrame, folder: str, batch_id: int) -> None:
    # One file per bucket, or a few where a bucket is large.
    write_batch(df.repartition("bucket"), f"{folder}/batches", batch_id, ["bucket"])


def file_purchases(spark: SparkSession, batch_id: int, root: str, buckets: int = BUCKETS) -> DataFrame:
    """Put the clean purchases of one batch on the shelf and return them with ``resent``, the ``former`` owner, and what the
    purchase ``was`` at its delivery before.

    A row that is older than the delivery already there counts for nothing. A replay files the same rows again.
    """
    place = shelf(root, buckets)
    batch = read_batches(spark, f"{root}/clean/purchases/batch_id={batch_id}", CLEAN_SCHEMA["purchases"]).select(
        *[c.split()[0] for c in _PURCHASE.split(", ")]).withColumn("bucket", bucket_of(buckets, "purchase_id"))
    owners = read_versioned(spark, f"{place}/owners", OWNERS, before=batch_id)
    n = batch.count()
    known = in_buckets_of(owners, batch).join(
        sized(batch.select("bucket", "purchase_id"), n), ["bucket", "purchase_id"], "left_semi")
    earlier = keep_latest(known, ["bucket", "purchase_id"], _LATEST).select(
        "bucket", "purchase_id", F.col("customer_id").alias("former"), F.col("ins_ts").alias("before"),
        F.struct("store_id", "total_amount", "purchase_datetime").alias("was"))
    met = batch.join(sized(earlier, n), ["bucket", "purchase_id"], "left").where("before IS NULL OR before <= ins_ts")
    path = write_batch(met.select(*[c.split()[0] for c in _PURCHASE.split(", ")], slice_of().alias("slice"),
                                  F.col("before").isNotNull().alias("resent"), "former", "was"), f"{place}/filed", batch_id)
    filed = spark.read.schema(FILED).parquet(path)

    _put(filed.drop("slice", "resent", "former", "was").withColumn("bucket", bucket_of(buckets, "purchase_id")),
         f"{place}/owners", batch_id)
    own = filed.withColumn("removed", F.lit(False))
    left = filed.where("former IS NOT NULL AND NOT former <=> customer_id").withColumns(
        {"customer_id": F.col("former"), "removed": F.lit(True)})
    held = own.unionByName(left).where("customer_id IS NOT NULL").drop("resent", "former", "was")
    _put(held.withColumn("bucket", bucket_of(buckets, "customer_id", "slice")), f"{place}/held", batch_id)
    return filed


def purchases_in(spark: SparkSession, root: str, cells: DataFrame, batch_id: int, buckets: int = BUCKETS) -> DataFrame:
    """The purchases of the cells (customer_id, slice) as of a batch: last deliveries, without those that moved away."""
    wanted = cells.select("customer_id", "slice").distinct().withColumn("bucket", bucket_of(buckets, "customer_id", "slice"))
    held = read_versioned(spark, f"{shelf(root, buckets)}/held", HELD, before=batch_id + 1)
    theirs = in_buckets_of(held, wanted).join(
        sized(wanted, cells.count()), ["bucket", "customer_id", "slice"], "left_semi")
    return keep_latest(theirs, ["customer_id", "purchase_id"], _LATEST).where("NOT removed").drop("removed", "batch_id")


def all_slices(customers: DataFrame) -> DataFrame:
    """Every cell of the customers."""
    return customers.select("customer_id", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))


def compact_shelf(spark: SparkSession, root: str, buckets: int = BUCKETS) -> str | None:
    """Fold all batches so far into one version per table, bucketed alike: the last owner of each purchase, and the last
    delivery of each customer's. Later batches read it in place of the folders it covers."""
    place = shelf(root, buckets)
    newest = read_batches(spark, f"{place}/owners/batches", OWNERS).agg(F.max("batch_id")).first()[0]
    if newest is None:
        return None
    version = f"{newest:020d}"
    owners = keep_latest(read_versioned(spark, f"{place}/owners", OWNERS), ["bucket", "purchase_id"], _LATEST)
    held = keep_latest(read_versioned(spark, f"{place}/held", HELD), ["bucket", "customer_id", "purchase_id"], _LATEST)
    for name, rows in (("owners", owners), ("held", held.where("NOT removed"))):
        publish_version(rows.where(F.col("batch_id") <= newest), f"{place}/{name}/compact", version, partition_by=["bucket"],
                        sort_by=["bucket", "purchase_id"])
    return version
