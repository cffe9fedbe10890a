"""Publish documents as JSON messages without a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_messages(documents: DataFrame, topic: str) -> DataFrame:
    """``topic, value``: each row as JSON text, NULL fields written out, non-ASCII text as it is."""
    return documents.select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in documents.columns]), {"ignoreNullFields": "false"}).alias("value"),
    )


def texts_to_messages(texts: DataFrame, topic: str) -> DataFrame:
    """``topic, value`` of documents that are text already (``body``)."""
    return texts.select(F.lit(topic).alias("topic"), F.col("body").alias("value"))


def publish_broker(messages: DataFrame, servers: str, **options: str) -> None:
    """Send to a broker; needs Spark's Kafka package."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save()


def publish_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Offline stand-in for the broker: Parquet files partitioned by topic, stamped with the send time."""
    stamped = messages.select("value", F.current_timestamp().alias("sent_at"), "topic")
    stamped.write.mode(mode).partitionBy("topic").parquet(path)
