"""Live panels equal their batch queries after every delivery; tables of last rows are compacted."""

import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_shelves import batches, land

from tillflow.operators.dashboards import customer_activity, revenue_by_region, revenue_by_store, trend_by_day
from tillflow.sinks.tables import compact_latest, latest_rows, write_batch
from tillflow.streaming import panels
from tillflow.streaming.ingest import current
from tillflow.streaming.shelves import file_purchases


def money(df):
    return rows(df.withColumn("revenue", F.round("revenue", 6)))


def test_panels_equal_batch_after_every_delivery(spark, tmp_path):
    root = str(tmp_path / "lake")
    stores = spark.createDataFrame([(f"s{k}", f"n{k}", f"city {k % 3}") for k in range(30)], "store_id string, store_name string, city string")
    for number, batch in enumerate(batches(7, 3, size=40)):
        land(spark, root, number, batch)
        for _ in range(2):  # a replay appends nothing
            panels.add_changes(file_purchases(spark, number, root, buckets=4), number, root)
        panels.start_panels(panels.read_changes(spark, root), root, f"{root}/checkpoint").awaitTermination()
        if number == 1:
            assert panels.compact_panels(spark, root) and panels.compact_panels(spark, root) is None
        now = current(spark, root, "purchases")
        assert money(panels.live_days(spark, root)) == money(trend_by_day(now))
        assert money(panels.live_stores(spark, root)) == money(revenue_by_store(now, stores).drop("store_name"))
        assert money(panels.live_regions(spark, root, stores)) == money(revenue_by_region(now, stores))
        assert rows(panels.live_activity(spark, root)) == rows(customer_activity(now).drop("days_since_last"))
        assert rows(panels.live_totals(spark, root), "purchases") == rows(now.agg(F.count("*")))


def test_one_state_store_holds_all_panels(spark, tmp_path):
    root = str(tmp_path / "lake")
    changes = spark.createDataFrame([("a", "s1", date(2025, 1, 1), 5.0, 1), ("a", "s1", date(2025, 1, 1), 5.0, -1), ("b", None, None, None, 1)],
                                    panels.CHANGES)
    write_batch(changes, f"{root}/changes", 0)
    query = panels.start_panels(panels.read_changes(spark, root), root, f"{root}/checkpoint")
    query.awaitTermination()
    assert len(query.lastProgress["stateOperators"]) == 1
    assert rows(panels.live_totals(spark, root)) == [(1, None)] or rows(panels.live_totals(spark, root)) == [(1, 0.0)]
    assert rows(panels.live_stores(spark, root), "store_id", "purchases") == [(None, 1)]
    assert panels.live_activity(spark, root).count() == 1


def test_nothing_yet(spark, tmp_path):
    assert panels.live_totals(spark, str(tmp_path)).count() == 0 and panels.compact_panels(spark, str(tmp_path)) is None


@pytest.mark.parametrize("seed", range(2))
def test_last_rows_through_compaction(spark, tmp_path, seed):
    draw, folder, want = random.Random(seed), str(tmp_path / "t"), {}
    for number in range(5):
        batch = {draw.randrange(6): draw.random() for _ in range(4)}
        want |= batch
        write_batch(spark.createDataFrame(list(batch.items()), "k int, v double"), f"{folder}/batches", number)
        if draw.random() < 0.5:
            compact_latest(spark, folder, "k int, v double", ["k"])
        assert dict(rows(latest_rows(spark, folder, "k int, v double", ["k"]).drop("batch_id"))) == want
