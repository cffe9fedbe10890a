"""Small helpers the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def written(df: DataFrame, label: str, by: Sequence[str] = (), **options: str) -> DataFrame:
    """``df`` as a Parquet table in a new folder below the shared checkpoint folder, with a subfolder per value of ``by``;
    ``options`` are the writer's.

    This cuts the lineage: whatever is lost later is read again from the shared folder, and row ids
    given with ``monotonically_increasing_id`` before the write stay what they were.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.options(**options)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(*tables: DataFrame | None) -> None:
    """Remove tables made by :func:`written` that no returned DataFrame reads any more."""
    for table in tables:
        for file in (table.inputFiles()[:1] if table is not None else []):
            folder = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def trimmed(function):
    """``function`` of record batches that gives unused memory back to the system when a task is done with it.

    Python workers live on from task to task; what their allocators keep counts against the executor.
    """

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def with_results(df: DataFrame, **results: Column) -> DataFrame:
    """The columns of ``df`` and the results; a result replaces an input column of its name."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in results]
    return df.select(*kept, *[v.alias(k) for k, v in results.items()])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``df`` does not use."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
