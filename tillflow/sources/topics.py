"""Message topics, from a broker or from files. Both give ``topic, value, sent_at``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import ENTITIES

FILE_SCHEMA = "value string, sent_at timestamp, topic string"


def _from_broker(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", F.col("value").cast("string").alias("value"), F.col("timestamp").alias("sent_at")
    )


def subscribe(spark: SparkSession, servers: str, topics: Sequence[str] = ENTITIES, **options: str) -> DataFrame:
    """Stream of several broker topics from their earliest message; needs Spark's Kafka package.

    ``minPartitions`` splits a topic partition that holds far more than the others, and
    ``maxOffsetsPerTrigger`` bounds a batch; pass either in ``options``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    return _from_broker(reader.options(**options).load())


def subscribe_files(spark: SparkSession, path: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """The same stream from a folder written by :func:`tillflow.sinks.topics.publish_files`."""
    reader = spark.readStream.schema(FILE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).select("topic", "value", "sent_at")


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """One topic as a bounded table."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    return _from_broker(reader.options(**options).load())


def peek(messages: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` messages; ordered, each task keeps ``n`` rows only."""
    return messages.orderBy(*order_by).limit(n) if order_by else messages.limit(n)
