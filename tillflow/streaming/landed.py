"""Copies that come long after the first delivery, caught when they are ingested.

Every batch leaves a bitmap of the hashes of its keys, and its keys in hash buckets. A later batch asks the bitmaps of all
batches before it: a key whose bit is not set is new for certain; the others, copies and the few new keys whose hash
was met by chance, are compared with the stored keys of their buckets. The bitmaps have no horizon, unlike a watermark, and
``2 ** BITS`` bits a batch at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.dedup import keep_first
from tillflow.sinks.tables import publish_version, read_batches, read_versioned, write_batch
from tillflow.streaming.shelves import in_buckets_of

BITS = 24
BUCKETS = 64

BITMAPS = "chunk bigint, bits binary"


def _position(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << BITS))


def _is_set(bits: Column, position: Column) -> Column:
    """Whether the bit of a position is set in the bitmap of its chunk."""
    place = F.bitmap_bit_position(position)
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def maybe_landed(batch: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch`` with ``maybe``: whether any earlier bitmap has the bit of the key."""
    merged = before.groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = batch.withColumns({"position": _position(keys), "chunk": F.bitmap_bucket_number(_position(keys))})
    return asked.join(merged, "chunk", "left").withColumn(
        "maybe", F.coalesce(_is_set(F.col("bits"), F.col("position")), F.lit(False))).drop("chunk", "position", "bits")


def drop_landed(batch: DataFrame, batch_id: int, root: str, keys: Sequence[str], time_column: str, *, buckets: int = BUCKETS) -> DataFrame:
    """The first delivery of each key of the batch that no earlier batch landed, stored below ``root``; a replay gives the same.

    Key columns must not be NULL in rows that are to be compared; a row with a NULL key is kept always.
    """
    spark = batch.sparkSession
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    shape = ", ".join(f"{k} {batch.schema[k].dataType.simpleString()}" for k in keys) + ", bucket int"
    first = keep_first(batch.where(whole), keys, [time_column])
    asked = maybe_landed(first, read_versioned(spark, f"{root}/bitmaps", BITMAPS, before=batch_id), keys)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    place = write_batch(asked.withColumn("bucket", bucket), f"{root}/asked", batch_id)
    stored = spark.read.schema(asked.withColumn("bucket", bucket).schema).parquet(place)
    maybe = stored.where("maybe")
    landed = in_buckets_of(read_batches(spark, f"{root}/keys", shape).where(F.col("batch_id") < batch_id), maybe)
    new = stored.where("NOT maybe").unionByName(
        maybe.join(landed.select("bucket", *keys), ["bucket", *keys], "left_anti"), allowMissingColumns=True).drop("maybe", "bucket")
    out = write_batch(new.unionByName(batch.where(~whole)), f"{root}/kept", batch_id)
    kept = spark.read.schema(batch.schema).parquet(out)
    hashed = kept.where(whole).select(*keys, bucket.alias("bucket"), _position(keys).alias("position"))
    write_batch(hashed.drop("position").repartition("bucket"), f"{root}/keys", batch_id, ["bucket"])
    bits = hashed.groupBy(F.bitmap_bucket_number("position").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bits"))
    write_batch(bits, f"{root}/bitmaps/batches", batch_id)
    return kept


def compact_bitmaps(spark: SparkSession, root: str) -> str | None:
    """Fold the bitmaps of all batches so far into one."""
    newest = read_batches(spark, f"{root}/bitmaps/batches", BITMAPS).agg(F.max("batch_id")).first()[0]
    if newest is None:
        return None
    rows = read_versioned(spark, f"{root}/bitmaps", BITMAPS).where(F.col("batch_id") <= newest)
    merged = rows.groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits")).withColumn("batch_id", F.lit(newest))
    return publish_version(merged, f"{root}/bitmaps/compact", f"{newest:020d}")
