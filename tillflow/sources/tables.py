"""Warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table, or a Parquet folder when the name holds a slash. Only used columns are scanned."""
    return spark.read.parquet(table) if "/" in table else spark.table(table)


def read_jdbc(spark: SparkSession, url: str, table: str, *, split_on: str, low: str, high: str,
              parts: int, **options: str) -> DataFrame:
    """An external warehouse table, read by ``parts`` parallel range queries over ``split_on``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=split_on, lowerBound=low, upperBound=high,
                 numPartitions=str(parts), **options)
        .load()
    )


def first_existing(spark: SparkSession, *tables: str) -> DataFrame:
    """The first table of the list that the catalog knows, e.g. the clean one before the typed one."""
    for table in tables:
        if spark.catalog.tableExists(table):
            return spark.table(table)
    raise ValueError(f"none of the tables exists: {', '.join(tables)}")


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a folder of files was written to its end, wherever it is stored."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)
