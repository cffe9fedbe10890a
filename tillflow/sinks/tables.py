"""Table writers that may run twice: a batch, and a version, each own a folder and overwrite it."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillflow.operators.dedup import keep_latest


def stamped(df: DataFrame) -> DataFrame:
    """Add the load time. Called on the way to storage only, so no compared result depends on it."""
    return df.withColumn("ins_ts", F.current_timestamp())


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> str:
    """Write one micro-batch; a replayed batch replaces its own folder and nothing else."""
    target = f"{path}/batch_id={batch_id}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    return target


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches written so far, with ``batch_id``; empty when there is none yet."""
    declared = f"{schema}, batch_id bigint"
    try:
        return spark.read.schema(declared).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], declared)


def refresh_table(df: DataFrame, table: str) -> None:
    """Full refresh of a catalog table, by column name; an empty input leaves an empty table.

    ``table`` is a view over the newest of its versions, which is complete before the view is turned to it in one step: there
    is no moment without a table, and a run that fails leaves the old one. The version before stays for readers that
    have begun; older ones go. A plain table of that name becomes the view at its first refresh.
    """
    spark, version = df.sparkSession, f"{table}_v{uuid.uuid4().hex}"
    before = _version_behind(spark, table)
    df.write.saveAsTable(version)
    if spark.catalog.tableExists(table) and before is None:
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    for old in _versions(spark, table):
        if old not in (version.split(".")[-1], (before or "").split(".")[-1]):
            spark.sql(f"DROP TABLE {'.'.join([*version.split('.')[:-1], old])}")


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Names of the versions of a table, a handful."""
    *database, name = table.split(".")
    place = f" IN {'.'.join(database)}" if database else ""
    return [r.tableName for r in spark.sql(f"SHOW TABLES{place} LIKE '{name}_v*'").collect()
            if re.fullmatch(re.escape(name.lower()) + "_v[0-9a-f]{32}", r.tableName.lower())]


def _version_behind(spark: SparkSession, table: str) -> str | None:
    """The version a refreshed table's view shows, or None where there is no such view."""
    if not spark.catalog.tableExists(table):
        return None
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    found = re.search(r"FROM (\S+_v[0-9a-f]{32})$", told.get("View Text") or "")
    return found.group(1) if found else None


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove a refreshed table with all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for version in _versions(spark, table):
        spark.sql(f"DROP TABLE {'.'.join([*table.split('.')[:-1], version])}")


def typed_defaults(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """NULL text as ``''`` and NULL numbers as 0, for stores whose columns cannot be NULL; times stay NULL."""
    filled = {f.name: "" if f.dataType.simpleString() == "string" else 0 for f in df.schema.fields
              if f.name not in keep and f.dataType.simpleString() in ("string", "int", "bigint", "double", "float")}
    return df.fillna(filled)


def publish_version(df: DataFrame, root: str, version: str, *, sort_by: Sequence[str] = (),
                    partition_by: Sequence[str] = ()) -> str:
    """Write a version of a folder table beside the old ones and return its name.

    The version is published by one small row only after its data is complete, so readers never
    see a half-written table. Versions are ordered as text. ``sort_by`` sorts inside each task's
    file, which gives row-group statistics without another shuffle.
    """
    out = df.repartition(*partition_by) if partition_by else df
    out = out.sortWithinPartitions(*sort_by) if sort_by else out
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/version={version}")
    announce_version(df.sparkSession, root, version)
    return version


def announce_version(spark: SparkSession, root: str, version: str) -> None:
    """Make a complete version the one that readers take."""
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{root}/published")


def refresh_folder(df: DataFrame, root: str, version: str, *, sort_by: Sequence[str] = ()) -> str:
    """Full refresh of a folder table: :func:`publish_version`, returning the version's path."""
    return f"{root}/version={publish_version(df, root, version, sort_by=sort_by)}"


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The newest published version below ``root``, or None."""
    try:
        return spark.read.schema("version string").parquet(f"{root}/published").agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest published version below ``root``, which may be an empty table."""
    return spark.read.parquet(f"{root}/version={latest_version(spark, root)}")


def read_versioned(spark: SparkSession, folder: str, schema: str, before: int | None = None) -> DataFrame:
    """The newest compacted version and the batches after it, with ``batch_id``; only batches ``before`` that one, if given.

    A version that already holds batch ``before`` is of no use for a replay of it; the batches themselves are read then.
    """
    rows, version = read_batches(spark, f"{folder}/batches", schema), latest_version(spark, f"{folder}/compact")
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    if version is None or (before is not None and int(version) >= before):
        return rows
    compact = spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{folder}/compact/version={version}")
    return rows.where(F.col("batch_id") > int(version)).unionByName(compact)


def latest_rows(spark: SparkSession, folder: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The last written row of each key, with its ``batch_id``."""
    return keep_latest(read_versioned(spark, folder, schema), keys, ["batch_id"])


def compact_latest(spark: SparkSession, folder: str, schema: str, keys: Sequence[str]) -> str | None:
    """Fold all batches so far into one version with the last row of each key; later reads rank only newer batches with it.

    Returns the version, or None if there is nothing new to fold.
    """
    newest = read_batches(spark, f"{folder}/batches", schema).agg(F.max("batch_id")).first()[0]
    if newest is None or f"{newest:020d}" == latest_version(spark, f"{folder}/compact"):
        return None
    rows = latest_rows(spark, folder, schema, keys).where(F.col("batch_id") <= newest)
    return publish_version(rows, f"{folder}/compact", f"{newest:020d}", sort_by=keys)
