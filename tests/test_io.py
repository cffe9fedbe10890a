"""Sources and sinks on local files, and the jobs built from them."""

import glob
import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.plans import jobs
from tillflow.session import shared_dir
from tillflow.sinks.csv import dated_name, export_csv
from tillflow.sinks.tables import _versions, drop_table, read_batches, read_latest, refresh_folder, refresh_table, stamped, write_batch
from tillflow.sinks.topics import publish_files
from tillflow.sources.documents import read_documents
from tillflow.sources.tables import first_existing, read_table
from tillflow.sources.topics import peek

RUN = datetime(2025, 8, 1, 9, 30)


@pytest.fixture
def documents(tmp_path):
    customers, purchases = tmp_path / "docs" / "customers", tmp_path / "docs" / "purchases"
    customers.mkdir(parents=True)
    purchases.mkdir()
    for i in range(3):
        doc = {"customer_id": f"c{i}", "first_name": "Имя", "email": f" C{i}@Example.com", "phone": "8 (915) 000-00-00",
               "birth_date": "1990-01-01", "registration_date": "2025-07-20T10:00:00.123456", "is_loyalty_member": i == 0,
               "purchase_location": {"city": "City"}}
        (customers / f"c{i}.json").write_text(json.dumps(doc, ensure_ascii=False, indent=2), encoding="utf-8")
        doc = {"purchase_id": f"o{i}", "customer": {"customer_id": f"c{i % 2}"}, "store": {"store_id": "s1"},
               "total_amount": 10.5, "payment_method": "cash", "is_delivery": False,
               "purchase_datetime": "2025-07-25T10:00:00.5", "items": [{"product_id": "p1", "quantity": 1, "total_price": 10.5}]}
        (purchases / f"o{i}.json").write_text(json.dumps(doc, indent=2), encoding="utf-8")
    (customers / "notes.txt").write_text("not a document")
    return str(tmp_path / "docs")


def test_read_documents(spark, documents):
    df = read_documents(spark, f"{documents}/customers", "customers")
    assert rows(df, "customer_id", "purchase_location.city") == [("c0", "City"), ("c1", "City"), ("c2", "City")]


def test_masked_messages_carry_no_contact_data(spark, documents):
    messages = jobs.masked_messages(spark, documents, "customers", "key").collect()
    assert len(messages) == 3
    for m in messages:
        body = json.loads(m.value)
        assert "email" not in body and "phone" not in body and len(body["email_masked"]) == 64
        assert "example.com" not in m.value.lower()
        assert body["first_name"] == "Имя" and "preferences" not in body  # what is absent stays absent


def test_publish_all(spark, documents, tmp_path):
    for entity in ("products", "stores"):
        (tmp_path / "docs" / entity).mkdir()
    target = str(tmp_path / "topics")
    aside = []
    jobs.publish_all(spark, documents, "key", lambda m: publish_files(m, target), lambda broken: aside.extend(broken.collect()))
    assert aside == []
    assert rows(spark.read.parquet(target).groupBy("topic").count()) == [("customers", 3), ("purchases", 3)]


def test_documents_stay_whole(spark, tmp_path):
    folder = tmp_path / "docs" / "products"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"id": "a", "price": "12.5", "is_organic": "true", "shelf": {"aisle": [3, null]}}')
    (folder / "b.json").write_text('{"id": "b", "price": 1')
    (folder / "c.json").write_text('{"id": "c", "email": null, "customer": {"phone": "8 915 000 00 00", "n": 1}, "email_masked": "old"}')
    sent = {json.loads(m.value)["id"]: json.loads(m.value)
            for m in jobs.masked_messages(spark, str(tmp_path / "docs"), "products", "key").collect()}
    assert sent["a"] == {"id": "a", "price": "12.5", "is_organic": "true", "shelf": {"aisle": [3, None]}}
    assert set(sent["c"]) == {"id", "email_masked", "customer"} and len(sent["c"]["email_masked"]) == 64
    assert set(sent["c"]["customer"]) == {"phone_masked", "n"}
    broken = jobs.broken_documents(spark, str(tmp_path / "docs"), "products").collect()
    assert [(r.source, r.raw_json, r.problem) for r in broken] == [("products", '{"id": "b", "price": 1', "unreadable document")]


def test_refresh_keeps_the_old_table_when_it_fails(spark):
    refresh_table(spark.range(3), "kept_table")
    with pytest.raises(Exception, match="broken"):
        refresh_table(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), "kept_table")
    assert spark.table("kept_table").count() == 3
    refresh_table(spark.range(5), "kept_table")
    assert spark.table("kept_table").count() == 5
    begun = spark.table("kept_table")
    refresh_table(spark.range(7), "kept_table")
    assert begun.count() == 5 and spark.table("kept_table").count() == 7
    refresh_table(spark.range(1), "kept_table")
    assert len(_versions(spark, "kept_table")) == 2  # the newest and the one before
    drop_table(spark, "kept_table")
    assert not spark.catalog.tableExists("kept_table") and _versions(spark, "kept_table") == []
    spark.range(4).write.saveAsTable("plain_table")
    refresh_table(spark.range(2), "plain_table")
    assert spark.table("plain_table").count() == 2
    drop_table(spark, "plain_table")


def test_peek(spark):
    df = spark.range(20).select(F.col("id").alias("n"))
    assert [r.n for r in peek(df, 5, ["n"]).collect()] == [0, 1, 2, 3, 4]
    assert peek(df).count() == 5


def test_export_csv(spark, tmp_path, caplog):
    df = spark.range(10).repartition(3)
    path = export_csv(df, str(tmp_path), "analytic_result", RUN)
    assert path.endswith("/analytic_result_2025_08_01.csv") and dated_name("x", RUN) == "x_2025_08_01.csv"
    assert len(glob.glob(f"{path}/part-*.csv")) == 3  # written where computed, not gathered
    assert rows(spark.read.option("header", True).schema("id long").csv(path)) == [(i,) for i in range(10)]
    assert export_csv(df.limit(1), str(tmp_path), "analytic_result", RUN) == path  # same day: replaced
    assert spark.read.option("header", True).csv(path).count() == 1
    assert export_csv(df, "nowhere://bucket", "x", RUN, required=False) is None
    assert "export to nowhere://bucket" in caplog.text
    with pytest.raises(Exception, match="nowhere"):
        export_csv(df, "nowhere://bucket", "x", RUN)


def test_batches_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_batches(spark, path, "id bigint").count() == 0
    for batch, n in ((0, 5), (1, 7), (1, 7)):
        write_batch(spark.range(n), path, batch)
    assert rows(read_batches(spark, path, "id bigint").groupBy("batch_id").count()) == [(0, 5), (1, 7)]


def test_refresh(spark, tmp_path):
    first = refresh_folder(stamped(spark.range(3)), str(tmp_path / "m"), "1", sort_by=["id"])
    second = refresh_folder(stamped(spark.range(0)), str(tmp_path / "m"), "2")
    assert spark.read.parquet(first).count() == 3
    assert spark.read.parquet(second).columns == ["id", "ins_ts"] and spark.read.parquet(second).count() == 0
    assert read_table(spark, first).count() == 3
    assert read_latest(spark, str(tmp_path / "m")).count() == 0
    refresh_folder(stamped(spark.range(4)), str(tmp_path / "m"), "3")
    stamped(spark.range(9)).write.parquet(str(tmp_path / "m" / "version=4"))  # written but never published
    latest = read_latest(spark, str(tmp_path / "m"))
    assert latest.columns == ["id", "ins_ts"] and latest.count() == 4


def test_tables_and_fallback(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    refresh_table(spark.range(2), "shop.customers")
    assert first_existing(spark, "shop.clean_customers", "shop.customers").count() == 2
    refresh_table(spark.range(1), "shop.clean_customers")
    assert first_existing(spark, "shop.clean_customers", "shop.customers").count() == 1
    refresh_table(spark.range(0), "shop.clean_customers")  # full refresh, also to nothing
    assert read_table(spark, "shop.clean_customers").count() == 0
    with pytest.raises(ValueError, match="none of the tables"):
        first_existing(spark, "shop.no", "shop.none")
    with pytest.raises(ValueError):
        jobs.warehouse(spark, "shop")
    spark.sql("DROP DATABASE shop CASCADE")


def test_shared_dir(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_mart_and_feature_jobs(spark, documents, tmp_path):
    from tillflow.operators.clean import clean
    from tillflow.operators.parse import parse

    raw = None
    for entity in ("customers", "purchases"):
        part = jobs.masked_messages(spark, documents, entity, "key").select(
            F.lit(RUN).alias("ts"), F.col("topic").alias("source"), F.col("value").alias("raw_json"))
        raw = part if raw is None else raw.unionByName(part)
    tables = {e: clean(parse(raw, e), e, as_of=RUN) for e in ("customers", "purchases")}
    stored = jobs.mart_job(tables["purchases"], tables["customers"], str(tmp_path / "mart"), str(tmp_path / "out"), RUN)
    assert stored.endswith("version=20250801T093000")
    mart = spark.read.parquet(stored)
    assert mart.columns == [*schemas.MART_COLUMNS, "ins_ts"]
    exported = spark.read.option("header", True).csv(str(tmp_path / "out" / "mart_customer_agg_2025_08_01.csv"))
    assert exported.columns == list(schemas.MART_COLUMNS)
    assert rows(exported, "customer_id", "purchase_count", "total_spent", "new_customer", "is_loyalty_member") == [
        ("c0", "2", "21.0", "1", "1"), ("c1", "1", "10.5", "1", "0")]
    products = spark.createDataFrame([("p1", "🥛🥛 молочные продукты")], "product_id string, category string")
    path = jobs.feature_job(tables["purchases"], products, str(tmp_path / "out"), RUN, windowed=True)
    assert rows(spark.read.option("header", True).csv(path), "customer_id", "bought_milk_last_30d") == [
        ("c0", "true"), ("c1", "true")]
