"""Bucketed history and mergeable states: what a batch reads, and that the marts equal a full recomputation."""

import json
import random
from datetime import datetime, timedelta

from conftest import rows
from metrics import files_read

from tillflow.operators.mart import customer_mart
from tillflow.streaming import shelves, states
from tillflow.streaming.ingest import current, land_batch
from tillflow.streaming.mart import current_mart, refresh_affected

AS_OF = "2025-06-01 00:00:00"


def purchase(i, customer, amount, day, store):
    return {"purchase_id": f"o{i}", "customer": {"customer_id": customer}, "store": {"store_id": store},
            "total_amount": amount, "payment_method": ("Card", "CASH", "gift")[i % 3], "is_delivery": i % 2 == 0,
            "purchase_datetime": (datetime(2025, 1, 1) + timedelta(days=day)).isoformat()}


def customer(name, loyal):
    return {"customer_id": name, "birth_date": "1990-01-01", "registration_date": "2025-05-15T00:00:00", "is_loyalty_member": loyal}


def batches(seed, count, size=60):
    """Random purchases; ids come again with other owners, amounts, days and stores; one customer has a third of them."""
    draw = random.Random(seed)
    for _ in range(count):
        out = []
        for _ in range(size):
            who = "hot" if draw.random() < 0.33 else draw.choice([None, "", *[f"c{k}" for k in range(8)]])
            out.append(("purchases", purchase(draw.randrange(90), who, draw.randrange(-5, 100), draw.randrange(100), draw.choice(
                [None, *[f"s{k}" for k in range(40)]]))))
        out.append(("customers", customer(f"c{draw.randrange(9)}", draw.random() < 0.5)))
        yield out


def land(spark, root, number, batch):
    messages = spark.createDataFrame([(t, json.dumps(d), datetime(2025, 5, 31, number)) for t, d in batch],
                                     "topic string, value string, sent_at timestamp")
    land_batch(messages, number, root, as_of=AS_OF)


def shown(df):
    return rows(df.selectExpr(*[f"round({c}, 6) AS {c}" if c in ("total_spent", "avg_basket") else c for c in df.columns]))


def full(spark, root):
    return customer_mart(current(spark, root, "purchases"), current(spark, root, "customers"), as_of=AS_OF)


def test_states_and_refresh_equal_a_full_mart_after_every_batch(spark, tmp_path):
    root = str(tmp_path / "lake")
    for number, batch in enumerate(batches(1, 4)):
        land(spark, root, number, batch)
        states.add_states(spark, number, root, buckets=4)
        refresh_affected(spark, number, root, as_of=AS_OF, buckets=4)
        want = shown(full(spark, root))
        assert shown(states.mart_from_states(spark, root, as_of=AS_OF)) == want
        assert shown(current_mart(spark, root, as_of=AS_OF)) == want
        if number == 1:
            assert states.compact_states(spark, root) and shelves.compact_shelf(spark, root, buckets=4)
            assert states.compact_states(spark, root) is None
            assert shown(states.mart_from_states(spark, root, as_of=AS_OF)) == want
    # A batch that runs again, also one below the compacted version, changes nothing.
    for number in (3, 1):
        states.add_states(spark, number, root, buckets=4)
    assert shown(states.mart_from_states(spark, root, as_of=AS_OF)) == want


def test_moved_purchase_leaves_its_former_owner(spark, tmp_path):
    root = str(tmp_path / "lake")
    sent = [[("purchases", purchase(1, "a", 5, 1, "s1"))], [("purchases", purchase(1, "b", 6, 2, "s2"))],
            [("purchases", purchase(2, "a", 7, 3, "s1"))], [("purchases", purchase(1, "a", 5, 1, "s3"))]]
    want = [[("a", 1, 5.0)], [("b", 1, 6.0)], [("a", 1, 7.0), ("b", 1, 6.0)], [("a", 2, 12.0)]]
    for number, batch in enumerate(sent):
        land(spark, root, number, batch)
        states.add_states(spark, number, root)
        assert rows(states.mart_totals(spark, root), "customer_id", "purchase_count", "total_spent") == want[number]


def test_late_copy_of_an_older_delivery_counts_for_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    land(spark, root, 0, [("purchases", purchase(1, "a", 5, 1, "s1"))])
    states.add_states(spark, 0, root)
    # The clean row carries an earlier load time than the one on the shelf.
    old = spark.read.parquet(f"{root}/clean/purchases/batch_id=0").selectExpr(
        "* EXCEPT (ins_ts, total_amount)", "ins_ts - INTERVAL 1 HOUR AS ins_ts", "99.0D AS total_amount")
    old.write.parquet(f"{root}/clean/purchases/batch_id=1")
    states.add_states(spark, 1, root)
    assert rows(states.mart_totals(spark, root), "purchase_count", "total_spent") == [(1, 5.0)]


def test_nothing_landed_and_batches_without_purchases(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert states.mart_from_states(spark, root, as_of=AS_OF).count() == 0 and states.compact_states(spark, root) is None
    assert shelves.compact_shelf(spark, root) is None
    land(spark, root, 0, [("customers", customer("a", True))])
    states.add_states(spark, 0, root)
    refresh_affected(spark, 0, root, as_of=AS_OF)
    assert states.mart_from_states(spark, root, as_of=AS_OF).count() == current_mart(spark, root, as_of=AS_OF).count() == 0


def test_a_batch_of_one_customer_reads_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "lake")
    land(spark, root, 0, [("purchases", purchase(i, f"c{i % 30}", 1, 1, "s")) for i in range(400)])
    states.add_states(spark, 0, root, buckets=32)
    everything = spark.read.parquet(f"{root}/shelf-32/held/batches")
    assert everything.select("bucket").distinct().count() == 32
    one = spark.createDataFrame([("c7", 3)], "customer_id string, slice int")
    theirs = shelves.purchases_in(spark, root, one, 0, buckets=32)
    plan = theirs._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert files_read(theirs) == 1
    assert files_read(shelves.purchases_in(spark, root, shelves.all_slices(one), 0, buckets=32)) <= shelves.SLICES


def test_new_purchases_are_added_without_reading_the_old(spark, tmp_path, monkeypatch):
    """Batches without repeats never open the purchases on the shelf, and states are written by one aggregate."""
    root = str(tmp_path / "lake")
    opened = []
    real = shelves.in_buckets_of
    monkeypatch.setattr(shelves, "in_buckets_of", lambda table, wanted: opened.append(
        ("removed" in table.columns, wanted.select("bucket").distinct().count())) or real(table, wanted))
    for number in range(3):
        land(spark, root, number, [("purchases", purchase(100 * number + i, f"c{i % 5}", 2, number, f"s{i % 7}")) for i in range(20)])
        states.add_states(spark, number, root)
    assert all(n == 0 for held, n in opened if held) and len(opened) == 6
    assert shown(states.mart_from_states(spark, root, as_of=AS_OF)) == shown(full(spark, root))


def test_more_stores_than_one_bitmap_holds(spark, tmp_path):
    known = spark.range(5).selectExpr("concat('s', id) AS store_id", "0 AS store_group", "32767 + id * 40000 AS place")
    bought = spark.range(50).selectExpr("'a' AS customer_id", "0 AS slice", "concat('s', id % 5) AS store_id", "concat('o', id) AS purchase_id",
                                        "1.0D AS total_amount", "'cash' AS payment_method", "1 AS is_delivery",
                                        "timestamp'2025-01-01' AS purchase_datetime", "false AS replaces")
    made = states._states(bought, known)
    assert made.count() == 5
    made.write.parquet(str(tmp_path / "lake/states/batches/batch_id=0"))
    assert rows(states.mart_totals(spark, str(tmp_path / "lake")), "purchase_count", "distinct_stores") == [(50, 5)]


def test_many_keys_are_not_sent_to_every_task(spark, tmp_path, monkeypatch):
    """A batch whose files are small but whose keys are counted to be many is joined by shuffles, with the same mart."""
    lakes = []
    for name, few in (("sent", 10**6), ("dealt", 0)):
        monkeypatch.setattr(shelves, "FEW_KEYS", few)
        root = str(tmp_path / name)
        for number, batch in enumerate(batches(3, 2)):
            land(spark, root, number, batch)
            refresh_affected(spark, number, root, as_of=AS_OF, buckets=4)
        cells = shelves.all_slices(spark.read.schema("customer_id string").parquet(f"{root}/affected/batch_id=1"))
        theirs = shelves.purchases_in(spark, root, cells, 1, buckets=4)
        assert ("BroadcastHashJoin" in theirs._jdf.queryExecution().executedPlan().toString()) == bool(few)
        lakes.append(shown(current_mart(spark, root, as_of=AS_OF)))
    assert lakes[0] == lakes[1]


def test_a_state_of_few_stores_is_a_short_row(spark):
    """Task memory: a state keeps the numbers of its stores, not a bitmap of 4 KB; and rows are dealt out by their count."""
    known = spark.createDataFrame([("s", 3, 7)], "store_id string, store_group int, place bigint")
    bought = spark.range(1).selectExpr("'a' AS customer_id", "0 AS slice", "'s' AS store_id", "'o' AS purchase_id", "1.0D AS total_amount",
                                       "'cash' AS payment_method", "1 AS is_delivery", "timestamp'2025-01-01' AS purchase_datetime",
                                       "false AS replaces")
    assert len(states._states(bought, known).first().stores) == 1
    parts = [states._spread(bought, n, "customer_id").rdd.getNumPartitions() for n in (1, 100 * states.TASK_ROWS)]
    assert parts == [spark.sparkContext.defaultParallelism, 100]
