"""Tables stored in hash buckets of a key, so that joins and groupings on that key need no shuffle.

Two tables with the same number of buckets of the same key type are joined bucket by bucket where they lie. The folder is the
caller's, on shared storage; the catalog only notes the layout. Spark reads a bucket in one task: a key that holds a large share
of a table should not be a bucketing key, use ``joins.fan_out_left_join`` or adaptive skew joins for such a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Above this share of the rows in one bucket, measured when the table is written, bucketing does more harm than good.
MOST_SHARE = 0.25


# Rows of a bucket that one task reads, sorts and joins; what it needs for them does not grow with the table.
BUCKET_ROWS = 400_000
LEAST_BUCKETS = 8


class SkewedBucket(ValueError):
    """One bucket would hold too much of the table."""


def buckets_for(df: DataFrame, rows: int = BUCKET_ROWS) -> int:
    """How many buckets the largest of the tables stored alike needs, so that a bucket holds about ``rows`` of its rows."""
    return max(LEAST_BUCKETS, -(-df.count() // rows))


def write_bucketed(df: DataFrame, table: str, folder: str, keys: Sequence[str], buckets: int, *,
                   most_share: float = MOST_SHARE) -> DataFrame:
    """Store ``df`` in ``buckets`` of ``keys``, sorted by them within each, as catalog table ``table``; returns it.

    One shuffle sends every bucket to one task, so a bucket is one file, whatever the number of tasks. A table of which one
    bucket would hold more than ``most_share`` of the rows, and more than its even part, is refused.
    """
    number = F.pmod(F.hash(*keys), F.lit(buckets))  # the same hash that bucketing uses
    sizes = df.groupBy(number.alias("bucket")).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    if sizes.rows and buckets > 1 and sizes.most > max(most_share, 2 / buckets) * sizes.rows and sizes.most > 10_000:
        raise SkewedBucket(f"a bucket of {table} holds {sizes.most} of {sizes.rows} rows")
    spread = df.repartition(buckets, *keys)
    spread.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """(buckets, keys) of a catalog table, or None where it has none."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not told.get("Num Buckets"):
        return None
    return int(told["Num Buckets"]), told["Bucket Columns"].strip("[]").replace("`", "").split(", ")


def forget(spark: SparkSession, *tables: str) -> None:
    """Take tables out of the catalog; their folders stay."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
