"""Folder tables laid out by key: rows of neighbouring keys lie in one file and one row group.

This is what a primary key of a sorted store gives its readers. A version is cut into ranges of the key, each file
is sorted, and a sparse index keeps the smallest and largest key of every file, so a lookup opens only files that can
hold the key; inside them Parquet's own statistics skip row groups and pages. Columns that are looked up but not sorted
by can have Bloom filters, which skip row groups that do not hold a value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.sinks.tables import announce_version, latest_version

# A range of this many rows makes a file where the caller does not say how many files there are.
ROWS_PER_FILE = 2_000_000
ROW_GROUP_BYTES = 16 << 20


def write_clustered(df: DataFrame, root: str, version: str, keys: Sequence[str], *, bloom: Sequence[str] = (),
                    files: int | None = None, distinct: int = 1_000_000, row_group_bytes: int = ROW_GROUP_BYTES) -> str:
    """Write and publish a version of ``df`` clustered by ``keys``; returns the version.

    ``bloom`` names columns that get Bloom filters made for ``distinct`` values a row group. Rows of one key may fill
    several files: a hash of the row comes last in the order of the ranges, so a hot key is no single task.
    """
    spark = df.sparkSession
    if files is None:
        files = max(-(-df.count() // ROWS_PER_FILE), 1)
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    ranged = df.repartitionByRange(files, *keys, whole).sortWithinPartitions(*keys)
    out = ranged.write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    for column in bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    data = f"{root}/version={version}"
    out.parquet(data)
    # Footers would do as well, but only the driver could read those of many files one by one.
    edges = [F.min(k).alias(f"low_{i}") for i, k in enumerate(keys)] + [F.max(k).alias(f"high_{i}") for i, k in enumerate(keys)]
    stored = spark.read.schema(df.schema).parquet(data).select(*keys, F.col("_metadata.file_path").alias("file"))
    index = stored.groupBy("file").agg(F.count("*").alias("rows"), *edges)
    index.write.mode("overwrite").parquet(f"{root}/index/version={version}")
    announce_version(spark, root, version)
    return version


def sparse_index(spark: SparkSession, root: str) -> DataFrame:
    """(file, rows, low_i, high_i): one row per file of the newest version, with the range of each key column."""
    return spark.read.parquet(f"{root}/index/version={latest_version(spark, root)}")


def lookup(spark: SparkSession, root: str, keys: Sequence[str], low: Sequence, high: Sequence | None = None, *,
           most_files: int = 10_000) -> DataFrame:
    """Rows of the newest version whose leading ``keys`` lie between ``low`` and ``high`` (inclusive; equal by default).

    Only the files whose ranges meet these bounds are opened. Bounds that meet more than ``most_files`` files are left to
    the row-group statistics of the whole version, so that no long list of files is gathered on the driver.
    """
    high = low if high is None else high
    version = f"{root}/version={latest_version(spark, root)}"
    wanted, meets = F.lit(True), F.lit(True)
    for i, (key, least, most) in enumerate(zip(keys, low, high, strict=False)):
        wanted = wanted & F.col(key).between(least, most)
        meets = meets & (F.col(f"low_{i}") <= most) & (F.col(f"high_{i}") >= least)
    files = [r.file for r in sparse_index(spark, root).where(meets).select("file").limit(most_files + 1).collect()]
    table = spark.read.parquet(version)
    if not files:
        return table.where(F.lit(False))
    if len(files) <= most_files:
        table = spark.read.schema(table.schema).parquet(*files)
    return table.where(wanted)
