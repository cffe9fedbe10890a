"""Streams must end where the batch jobs end."""

import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import clean as cleaning
from tillflow.operators.dashboards import trend_by_day
from tillflow.operators.dedup import keep_latest
from tillflow.operators.mart import customer_mart
from tillflow.operators.parse import parse
from tillflow.sources.topics import FILE_SCHEMA, subscribe_files
from tillflow.streaming.dedup import drop_redelivered
from tillflow.streaming.ingest import current, land_batch, start_ingest
from tillflow.streaming.mart import current_mart, refresh_affected
from tillflow.streaming.trend import current_trend, start_trend

AS_OF = "2025-02-01 00:00:00"


def purchase(i, customer, amount, day):
    return {"purchase_id": f"o{i}", "customer": {"customer_id": customer}, "store": {"store_id": f"s{i % 3}"},
            "total_amount": amount, "payment_method": "Card", "is_delivery": i % 2 == 0,
            "purchase_datetime": f"2025-01-{day:02d}T10:00:00"}


def customer(name, loyal):
    return {"customer_id": name, "birth_date": "1990-01-01", "registration_date": "2025-01-15T00:00:00", "is_loyalty_member": loyal}


BATCHES = [
    [("purchases", purchase(i, f"c{i % 4}", 10 + i, 1 + i)) for i in range(12)] + [("customers", customer("c0", False))],
    [("purchases", purchase(3, "c9", 99, 4)),            # sent again, now with another owner and amount
     ("purchases", purchase(50, "c1", -5, 4)),           # rejected
     ("purchases", "{broken"), ("gossip", {"x": 1}), ("customers", customer("c0", True))],
    [("purchases", purchase(3, "c9", 99, 4)), ("purchases", purchase(60, "c1", 7, 20)),
     ("purchases", purchase(61, "c3", 5, 21)), ("customers", customer("c9", True))],
]


def send(spark, path, batches):
    for n, batch in enumerate(batches):
        rows_ = [(d if isinstance(d, str) else json.dumps(d), datetime(2025, 1, 31, n), topic) for topic, d in batch]
        spark.createDataFrame(rows_, FILE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def all_raw(spark, path):
    return spark.read.parquet(path).select(F.col("sent_at").alias("ts"), F.col("topic").alias("source"), F.col("value").alias("raw_json"))


@pytest.fixture
def topics(spark, tmp_path):
    path = str(tmp_path / "topics")
    send(spark, path, BATCHES)
    return path


def run(spark, topics, root, **options):
    stream = subscribe_files(spark, topics, files_per_trigger=1)
    start_ingest(stream, root, f"{root}/checkpoint", as_of=AS_OF, **options).awaitTermination()


def test_ingest_equals_batch(spark, topics, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, topics, root)
    raw = all_raw(spark, topics)
    for entity in ("customers", "purchases"):
        batch = cleaning.clean(parse(raw, entity), entity, as_of=AS_OF)
        assert rows(current(spark, root, entity).select(batch.columns)) == rows(batch)
    assert rows(spark.read.parquet(f"{root}/quarantine"), "problem") == [("unknown topic",), ("unreadable document",)]
    assert spark.read.parquet(f"{root}/raw").count() == sum(map(len, BATCHES))
    # A restart finds nothing new; new messages are taken from where it stopped.
    run(spark, topics, root)
    assert spark.read.parquet(f"{root}/raw").count() == sum(map(len, BATCHES))
    send(spark, topics, [[("purchases", purchase(70, "c1", 1, 21))]])
    run(spark, topics, root)
    assert current(spark, root, "purchases").where("purchase_id = 'o70'").count() == 1


def test_replayed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    messages = spark.createDataFrame(
        [("purchases", json.dumps(purchase(1, "c1", 5, 2)), datetime(2025, 1, 31))], "topic string, value string, sent_at timestamp")
    for _ in range(2):
        land_batch(messages, 4, root, as_of=AS_OF)
    assert spark.read.parquet(f"{root}/raw").count() == 1
    assert current(spark, root, "purchases").count() == 1


def test_streamed_mart_equals_full_refresh(spark, topics, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, topics, root, after_batch=lambda s, b: refresh_affected(s, b, root, as_of=AS_OF))
    full = customer_mart(current(spark, root, "purchases"), current(spark, root, "customers"), as_of=AS_OF)
    got = current_mart(spark, root, as_of=AS_OF)
    assert rows(got) == rows(full) and got.count() == 5
    assert rows(got.where("customer_id = 'c9'"), "purchase_count", "total_spent", "is_loyalty_member") == [(1, 99.0, 1)]
    assert {r.new_customer for r in got.where("registration_date IS NOT NULL").collect()} == {1}
    assert current_mart(spark, root, as_of="2025-06-01 00:00:00").where("new_customer = 1").count() == 0


@pytest.mark.parametrize("salts", [1, 4])
def test_redelivered_messages(spark, tmp_path, salts):
    path = str(tmp_path / "in")
    once = spark.range(100).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.timestamp_seconds(F.col("id") + 1735689600).alias("ts"))
    for _ in range(3):
        once.repartition(4).write.mode("append").parquet(path)
    stream = spark.readStream.schema("k long, ts timestamp").option("maxFilesPerTrigger", 3).parquet(path)
    kept = drop_redelivered(stream, ["k"], "ts", "1 day", salts=salts)
    query = (kept.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out, "k") == rows(once.select("k").distinct())
    assert rows(keep_latest(out, ["k"], ["ts"]), "k") == rows(out, "k")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_trend_equals_batch(spark, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        trend(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def trend(spark, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "lake")
    sales = spark.range(200).select(
        F.timestamp_seconds(1735689600 + F.col("id") * 40000 % 900000).alias("purchase_datetime"), (F.col("id") * 1.0).alias("total_amount"))
    sales.repartition(5).write.parquet(path)
    stream = spark.readStream.schema("purchase_datetime timestamp, total_amount double").option("maxFilesPerTrigger", 2).parquet(path)
    start_trend(stream, root, f"{root}/checkpoint", "30 days").awaitTermination()
    assert rows(current_trend(spark, root)) == rows(trend_by_day(sales))


def test_schemas_of_stored_layers_match_what_is_written(spark, topics, tmp_path):
    from tillflow.streaming.ingest import CLEAN_SCHEMA, TYPED_SCHEMA

    raw = all_raw(spark, topics)
    for entity in schemas.ENTITIES:
        typed = parse(raw, entity)
        shape = [(f.name, f.dataType) for f in typed.schema]
        assert shape == [(f.name, f.dataType) for f in spark.createDataFrame([], TYPED_SCHEMA[entity]).schema]
        shape = {(f.name, f.dataType.simpleString()) for f in cleaning.clean(typed, entity).schema}
        assert shape == {(f.name, f.dataType.simpleString()) for f in spark.createDataFrame([], CLEAN_SCHEMA[entity]).schema}
