"""Schema drift against what was put in; copies that come batches later; quarantined rows driven again."""

import json
import random
from datetime import datetime, timedelta

from conftest import rows
from metrics import files_read
from pyspark.sql import functions as F
from test_shelves import AS_OF, land, purchase

from tillflow.operators import drift
from tillflow.sinks.tables import read_batches
from tillflow.sinks.topics import publish_files
from tillflow.sources.topics import subscribe_files
from tillflow.streaming import landed
from tillflow.streaming.ingest import current, start_ingest

RAW = "ts timestamp, source string, raw_json string"


def raw(spark, *documents):
    return spark.createDataFrame([(datetime(2025, 1, 1), s, d if isinstance(d, str) or d is None else json.dumps(d)) for s, d in documents], RAW)


def test_report_lists_undeclared_and_retyped_paths(spark):
    frame = raw(
        spark, ("products", {"id": "a", "price": 5, "kbju": {"calories": 1.5, "iron": 2}, "manufacturer": None}),
        ("products", {"id": 7, "price": "5", "kbju": [1], "extra": {"deep": {"er": 1}}, "is_organic": "yes"}),
        ("products", {"id": "b", "price": 2.5, "extra": 3, "it's": 1}), ("products", "{broken"), ("products", "[1]"), ("products", None),
        ("purchases", {"items": [{"unknown": 1}], "customer": {"customer_id": "c", "location": {}}, "store": {"location": {"moon": True}}}),
        ("gossip", {"x": 1}))
    got = {(r.entity, r.path): (r.problem, r.kind, r.documents) for r in drift.drift_report(drift.shapes(frame)).collect()}
    assert got == {
        ("products", "kbju.iron"): ("undeclared", "BIGINT", 1), ("products", "id"): ("retyped", "BIGINT", 1),
        ("products", "price"): ("retyped", "STRING", 1), ("products", "kbju"): ("retyped", "ARRAY", 1),
        ("products", "is_organic"): ("retyped", "STRING", 1), ("products", "it's"): ("undeclared", None, 1),
        ("purchases", "customer.location"): ("undeclared", "OBJECT", 1), ("purchases", "store.location.moon"): ("undeclared", "BOOLEAN", 1),
    } | {k: got[k] for k in got if k == ("products", "extra")}
    assert sorted(r.kind for r in drift.drift_report(drift.shapes(frame)).where("path = 'extra'").collect()) == ["BIGINT", "OBJECT"]
    assert drift.drift_report(drift.shapes(frame.limit(0))).count() == 0


def test_whole_shape_of_a_topic(spark):
    shapes = dict(rows(drift.whole_schema(raw(spark, ("a", {"x": 1}), ("a", {"x": "t", "y": True}), ("a", "{"), ("b", {"z": [1.5]})))))
    assert shapes["a"] == "OBJECT<x: VARIANT, y: BOOLEAN>" and shapes["b"].startswith("OBJECT<z: ARRAY<")


def test_mended_rows_are_published_and_ingested(spark, tmp_path):
    root, topics = str(tmp_path / "lake"), str(tmp_path / "topics")
    whole = json.dumps(purchase(1, "a", 5, 1, "s1"))
    bad = spark.createDataFrame([("purchases", whole[:-1]), ("purchases", "nothing to mend"), ("gossip", "{}")], "topic string, value string")

    def run():
        start_ingest(subscribe_files(spark, topics), root, f"{root}/checkpoint", as_of=AS_OF).awaitTermination()

    publish_files(bad, topics)
    run()
    assert current(spark, root, "purchases").count() == 0
    quarantined = spark.read.parquet(f"{root}/quarantine")
    messages, rest = drift.redrive(quarantined, lambda text: F.concat(text, F.lit("}")))
    assert rows(rest, "raw_json") == [("nothing to mend",), ("{}",)]
    publish_files(messages, topics)
    run()
    assert rows(current(spark, root, "purchases"), "purchase_id", "customer_id") == [("o1", "a")]


def test_copies_many_batches_apart_are_dropped_when_they_come(spark, tmp_path, monkeypatch):
    root, draw, seen, start = str(tmp_path / "landed"), random.Random(3), set(), datetime(2025, 1, 1)
    monkeypatch.setattr(landed, "BITS", 9)  # few bits: new keys meet set ones all the time and are settled exactly
    for number in range(5):
        sent = [(draw.choice([None, *range(150)]), start + timedelta(days=number, minutes=i), i) for i in range(60)]
        frame = spark.createDataFrame(sent, "k long, ts timestamp, v int")
        for _ in range(2):  # a replay gives the same
            kept = landed.drop_landed(frame, number, root, ["k"], "ts", buckets=8)
        first = {}
        for k, _, v in sent:
            first.setdefault(k, v)
        want = [(k, v) for k, v in first.items() if k is not None and k not in seen] + [(None, v) for k, _, v in sent if k is None]
        assert rows(kept, "k", "v") == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
        seen |= {k for k in first if k is not None}
        if number == 2:
            landed.compact_bitmaps(spark, root)
    stored = read_batches(spark, f"{root}/kept", "k long, ts timestamp, v int").where("k IS NOT NULL")
    assert stored.count() == stored.select("k").distinct().count() == len(seen)


def test_new_keys_are_settled_by_the_bitmap_alone(spark, tmp_path):
    root = str(tmp_path / "landed")
    frame = spark.range(500).selectExpr("id AS k", "timestamp'2025-01-01' AS ts")
    landed.drop_landed(frame, 0, root, ["k"], "ts")
    new = frame.selectExpr("k + 100000 AS k", "ts")
    asked = landed.maybe_landed(new, read_batches(spark, f"{root}/bitmaps/batches", landed.BITMAPS), ["k"])
    assert asked.where("maybe").count() <= 3  # 500 of 16 million bits are set
    assert landed.maybe_landed(frame, read_batches(spark, f"{root}/bitmaps/batches", landed.BITMAPS), ["k"]).where("NOT maybe").count() == 0
    assert landed.drop_landed(new, 1, root, ["k"], "ts").count() == 500
    assert files_read(spark.read.parquet(f"{root}/asked/batch_id=1").where("maybe")) >= 1


def test_unknown_topics_share_one_folder(spark, tmp_path):
    root = str(tmp_path / "lake")
    land(spark, root, 0, [(f"made-up-{i}", {"x": i}) for i in range(30)] + [("purchases", purchase(1, "a", 5, 1, "s1"))])
    stored = spark.read.parquet(f"{root}/raw")
    assert {r.topic for r in stored.select("topic").distinct().collect()} == {"other", "purchases"}
    assert stored.select("source").distinct().count() == 31
