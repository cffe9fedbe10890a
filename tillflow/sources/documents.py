"""Source documents: directories of JSON files, one object per file or per line.

Documents are read as text and stay whole: fields nobody declared and the types of scalars survive, and a document
that cannot be read keeps its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import DOCUMENTS


def read_texts(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """The text of all ``*.json`` objects below ``path``: ``body``.

    ``multi_line=False`` reads one object per line, which can be split: prefer it for large inputs.
    """
    texts = spark.read.text(path, wholetext=multi_line, pathGlobFilter="*.json")
    return texts.select(F.col("value").alias("body")).where(F.trim("body") != "")


def readable(texts: DataFrame) -> DataFrame:
    """The documents whose top-level fields can be listed, i.e. complete JSON objects."""
    return texts.where(F.json_object_keys("body").isNotNull())


def unreadable(texts: DataFrame, entity: str) -> DataFrame:
    """The others as quarantine rows: ``source, raw_json, problem``."""
    return texts.where(F.json_object_keys("body").isNull()).select(
        F.lit(entity).alias("source"), F.col("body").alias("raw_json"), F.lit("unreadable document").alias("problem"))


def read_documents(spark: SparkSession, path: str, entity: str, *, multi_line: bool = True) -> DataFrame:
    """The declared fields of the readable documents, as columns."""
    decoded = readable(read_texts(spark, path, multi_line=multi_line)).select(
        F.from_json("body", DOCUMENTS[entity]).alias("d"))
    return decoded.select("d.*")
