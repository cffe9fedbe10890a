"""Running totals for the live panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.sinks.tables import compact_latest, latest_rows, write_batch

TREND_SCHEMA = "day date, purchases bigint, revenue double"


def trend_by_day_stream(purchases: DataFrame, delay: str = "1 day") -> DataFrame:
    """Purchases and revenue per day; state holds one row per open day.

    In append mode a day is final once the watermark passes it; in update mode it is corrected
    with every batch. Windows are cut at midnight UTC, so times are first moved by the session
    zone's offset and the window start is moved back.
    """
    zone = purchases.sparkSession.conf.get("spark.sql.session.timeZone")
    local = purchases.withColumn("_local", F.from_utc_timestamp("purchase_datetime", zone))
    days = local.withWatermark("_local", delay).groupBy(F.window("_local", "1 day"))
    return days.agg(F.count(F.lit(1)).alias("purchases"), F.sum("total_amount").alias("revenue")).select(
        F.to_date(F.to_utc_timestamp("window.start", zone)).alias("day"), "purchases", "revenue"
    )


def start_trend(purchases: DataFrame, root: str, checkpoint: str, delay: str = "1 day", *, every: str | None = None
                ) -> StreamingQuery:
    """Append the corrected days of each batch, up to the end of what the source holds now; with ``every``, e.g.
    ``"10 seconds"``, go on in batches of that interval until stopped."""
    return (
        trend_by_day_stream(purchases, delay)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, f"{root}/trend/batches", batch_id) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def current_trend(spark: SparkSession, root: str) -> DataFrame:
    """The last correction of each day."""
    return latest_rows(spark, f"{root}/trend", TREND_SCHEMA, ["day"]).drop("batch_id")


def compact_trend(spark: SparkSession, root: str) -> str | None:
    """Fold the corrections so far into one version with one row per day."""
    return compact_latest(spark, f"{root}/trend", TREND_SCHEMA, ["day"])
