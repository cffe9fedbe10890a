"""Messages → raw → typed → clean tables, micro-batch by micro-batch.

Each batch lands its raw rows first and derives the rest from what it landed, so the later steps
do not depend on the source being readable twice. Every table folder is keyed by ``batch_id``: a
batch that runs again after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow import schemas
from tillflow.functions.clock import AsOf
from tillflow.operators import clean as cleaning
from tillflow.operators.dedup import keep_latest
from tillflow.operators.parse import decode, is_readable, project, quarantine
from tillflow.sinks.tables import latest_version, read_batches, refresh_folder, write_batch

_TYPES = {"text": "string", "float": "double", "uint16": "int", "flag": "int", "day": "date", "instant": "timestamp"}

TYPED_SCHEMA = {
    entity: ", ".join(f"{f.name} {_TYPES[f.kind]}" for f in fields) + ", ins_ts timestamp"
    for entity, fields in schemas.TYPED.items()
}


def _clean_schema(entity: str) -> str:
    rules = cleaning.RULES[entity]
    columns = [
        f"{f.name} {'timestamp' if f.name in rules.as_timestamp else _TYPES[f.kind]}"
        for f in schemas.TYPED[entity]
        if f.name not in rules.dropped
    ]
    return ", ".join(columns) + ", ins_ts timestamp"


CLEAN_SCHEMA = {entity: _clean_schema(entity) for entity in schemas.ENTITIES}


def raw_records(messages: DataFrame) -> DataFrame:
    """Message → raw row; the load time stands in where the message carries no time."""
    return messages.select(
        F.coalesce("sent_at", F.current_timestamp()).alias("ts"),
        F.col("topic").alias("source"),
        F.col("value").alias("raw_json"),
    )


OTHER = "other"


def land_raw(raw: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Store one batch of raw rows in a folder per known topic and one for all others; returns them as stored.

    Whatever names senders make up, there are five folders; the name itself stays in ``source``.
    """
    known = F.when(F.col("source").isin(*schemas.ENTITIES), F.col("source")).otherwise(OTHER)
    landed = write_batch(raw.withColumn("topic", known), path, batch_id, ["topic"])
    return raw.sparkSession.read.schema(f"{schemas.RAW}, topic string").parquet(landed)


def land_batch(messages: DataFrame, batch_id: int, root: str, *, as_of: AsOf = None) -> None:
    """Write one batch of messages through every layer below ``root``."""
    spark = messages.sparkSession
    raw = land_raw(raw_records(messages), f"{root}/raw", batch_id)
    write_batch(quarantine(raw), f"{root}/quarantine", batch_id)
    # Which of the known topics this batch holds: four names at most, whatever else was sent.
    known = raw.where(F.col("topic") != OTHER).select("topic").distinct()
    for entity in sorted(row.topic for row in known.collect()):
        typed_path = write_batch(
            project(decode(raw.where(F.col("topic") == entity), entity).where(is_readable()), entity),
            f"{root}/typed/{entity}", batch_id
        )
        typed = spark.read.schema(TYPED_SCHEMA[entity]).parquet(typed_path)
        # Copies inside the batch are resolved here, copies across batches by current().
        write_batch(
            cleaning.clean(typed, entity, as_of=as_of), f"{root}/clean/{entity}", batch_id
        )


def start_ingest(messages: DataFrame, root: str, checkpoint: str, *, as_of: AsOf = None,
                 after_batch=None, every: str | None = None) -> StreamingQuery:
    """Run :func:`land_batch` over everything the source holds now, then stop; with ``every``, e.g. ``"10 seconds"``,
    go on in batches of that interval until stopped.

    ``after_batch(spark, batch_id)`` runs once a batch is on storage, e.g. to refresh the mart.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, root, as_of=as_of)
        if after_batch:
            after_batch(batch.sparkSession, batch_id)

    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def history(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Every clean row ever landed for the entity, repeats included."""
    return read_batches(spark, f"{root}/clean/{entity}", CLEAN_SCHEMA[entity])


def _last_deliveries(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The last delivery of each key with its batch: from the newest compacted version and the batches after it."""
    rows, folder = history(spark, root, entity), f"{root}/compact/{entity}"
    version = latest_version(spark, folder)
    if version is not None:
        rows = rows.where(F.col("batch_id") > int(version)).unionByName(spark.read.parquet(f"{folder}/version={version}"))
    return keep_latest(rows, [schemas.KEYS[entity]], ["ins_ts", "batch_id"])


def current(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The clean table as readers want it: the last delivery of each key, however late it came."""
    return _last_deliveries(spark, root, entity).drop("batch_id")


def compact(spark: SparkSession, root: str, entity: str) -> str | None:
    """Fold all batches so far into one version with one row per key; later reads rank only newer batches against it.

    The version is published when it is complete and named after the last batch in it. Older batch folders are no
    longer read by :func:`current` and may be deleted by whoever owns the store.
    """
    newest = history(spark, root, entity).agg(F.max("batch_id")).first()[0]
    if newest is None:
        return None
    upto = _last_deliveries(spark, root, entity).where(F.col("batch_id") <= newest)
    return refresh_folder(upto, f"{root}/compact/{entity}", f"{newest:020d}", sort_by=[schemas.KEYS[entity]])
