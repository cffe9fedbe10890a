"""Parsing, cleaning, masking and items, on hand-written edge rows."""

import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import clean as cleaning
from tillflow.operators.items import enrich_items, explode_items
from tillflow.operators.masking import mask_documents, mask_fields
from tillflow.operators.parse import decode, parse, parse_customers, parse_products, parse_purchases, parse_stores, quarantine
from tillflow.sinks.topics import to_messages
from tillflow.functions.masking import mask_phone, mask_value

ARRIVED = datetime(2025, 1, 1)


def raw(spark, entity, *docs):
    text = [d if isinstance(d, str) or d is None else json.dumps(d, ensure_ascii=False) for d in docs]
    return spark.createDataFrame([(ARRIVED, entity, t) for t in text], schemas.RAW)


CUSTOMER = {
    "customer_id": "c1", "first_name": "ИВАН", "last_name": "Test", "email_masked": "e", "phone_masked": "p",
    "gender": "Male", "birth_date": "1990-05-06", "registration_date": "2024-03-04T05:06:07.891011",
    "is_loyalty_member": True, "loyalty_card_number": "77",
    "purchase_location": {"city": "Big City", "street": "Long Street", "house": "1", "postal_code": "000"},
}


def test_parse_customer(spark):
    got = parse_customers(raw(spark, "customers", CUSTOMER)).collect()[0].asDict()
    assert got["registration_date"] == datetime(2024, 3, 4, 5, 6, 7)  # whole seconds
    assert got["birth_date"] == date(1990, 5, 6)
    assert (got["is_loyalty_member"], got["city"], got["ins_ts"]) == (1, "Big City", ARRIVED)


def test_missing_paths_and_wrong_types(spark):
    got = parse_customers(raw(spark, "customers", {"customer_id": 5, "birth_date": "soon", "is_loyalty_member": "TRUE"}))
    row = got.collect()[0]
    assert (row.customer_id, row.birth_date, row.registration_date, row.is_loyalty_member, row.city) == (
        "5", None, None, 1, None)
    blank = parse_customers(raw(spark, "customers", {}), blank_as_empty=True).collect()[0]
    assert (blank.customer_id, blank.city, blank.birth_date) == ("", "", None)


def test_strict_registration_date(spark):
    bad = raw(spark, "customers", {**CUSTOMER, "registration_date": "someday"})
    assert parse_customers(bad).collect()[0].registration_date is None
    with pytest.raises(PySparkException, match="someday"):
        parse_customers(bad, strict=True).collect()


def test_parse_products_and_float32(spark):
    doc = {"id": "p1", "group": "Dairy", "price": 1127.48, "kbju": {"calories": "3.5", "fat": "x"}, "expiry_days": 70000,
           "is_organic": False, "manufacturer": {"name": "M", "inn": "1"}}
    row = parse_products(raw(spark, "products", doc, {**doc, "expiry_days": 65535})).orderBy("expiry_days").collect()
    assert [r.expiry_days for r in row] == [None, 65535]
    assert (row[0].product_id, row[0].category, row[0].price, row[0].calories, row[0].fat, row[0].manufacturer_inn) == (
        "p1", "Dairy", 1127.48, 3.5, None, "1")
    assert parse_products(raw(spark, "products", doc), narrow_float32=True).collect()[0].price == 1127.47998046875


def test_parse_stores(spark):
    doc = {"store_id": "s1", "accepts_online_orders": True, "warehouse_connected": False, "manager": {"name": "N"},
           "location": {"city": "C"}, "last_inventory_date": "2024-01-02"}
    row = parse_stores(raw(spark, "stores", doc)).collect()[0]
    assert (row.accepts_online_orders, row.delivery_available, row.warehouse_connected, row.manager_name, row.city,
            row.last_inventory_date) == (1, 0, 0, "N", "C", date(2024, 1, 2))


PURCHASE = {
    "purchase_id": "o1", "customer": {"customer_id": "c1"}, "store": {"store_id": "s1"}, "total_amount": 30.5,
    "payment_method": "Cash", "is_delivery": True, "purchase_datetime": "2024-06-01T10:00:00",
    "delivery_address": {"city": "X"},
    "items": [
        {"product_id": "p1", "name": "A", "category": "K", "quantity": 2, "price_per_unit": 10.0, "total_price": 20.0},
        {"product_id": "p2", "quantity": 1, "total_price": 10.5},
    ],
}


def test_items(spark):
    purchases = parse_purchases(raw(
        spark, "purchases", PURCHASE, {**PURCHASE, "purchase_id": "o2", "items": []},
        {"purchase_id": "o3"}, {**PURCHASE, "purchase_id": "o4", "items": "none"}))
    assert json.loads(purchases.where("purchase_id = 'o1'").collect()[0].items_json)[1]["product_id"] == "p2"
    items = explode_items(purchases)
    assert rows(items, "purchase_id", "customer_id", "product_id", "quantity", "total_price") == [
        ("o1", "c1", "p1", 2, 20.0), ("o1", "c1", "p2", 1, 10.5)]
    assert rows(explode_items(purchases, keep_empty=True).where("product_id IS NULL"), "purchase_id") == [
        ("o2",), ("o3",), ("o4",)]
    products = spark.createDataFrame([("p1", "milk")], "product_id string, category string")
    assert rows(enrich_items(items, products), "product_id", "category") == [("p1", "milk"), ("p2", None)]


def test_decoding_only_some_columns_gives_the_same_values(spark):
    source = raw(spark, "purchases", PURCHASE, {"purchase_id": "o3"})
    some = ["purchase_id", "store_id", "items_json"]
    assert rows(parse(source, "purchases", some), *some) == rows(parse(source, "purchases"), *some)
    assert set(decode(source, "purchases", some).schema["doc"].dataType.names) == {
        "purchase_id", "store", "items", schemas.CORRUPT}


def test_quarantine_and_parse_split_every_row(spark):
    bad = ["{broken", '["a"]', '"text"', "null", "", None, '{"id": {bad}}', '[{"id": "p1"}]', "  ", '{"id": "p1"', "{]", "12",
           '{"id": "p1", "x": {"y": [1, }}', "true", '{"id" "p1"}']
    good = [{"id": "p1"}, {}, {"id": 5, "kbju": "not an object", "price": "7"}, '{"id": "t1"} and more', '{"id": "t2"}{"id": 3}',
            "{'id': 't3'}", '{"id": "t4", "name": "tab\tinside"}', ' {"id": "t5", "id": "t6"} ', '{"id": "t7", "kbju": [1, 2]}']
    source = raw(spark, "products", *bad, *good).unionByName(raw(spark, "gossip", "{}"))
    rejected = quarantine(source)
    assert rejected.where("problem = 'unreadable document'").count() == len(bad)
    assert rejected.where("problem = 'unknown topic'").count() == 1
    parsed = parse_products(source)
    assert parsed.count() == len(good)
    assert rows(parsed.where("product_id IN ('5', 'p1')"), "product_id", "price", "calories") == [
        ("5", 7.0, None), ("p1", None, None)]


def test_clean_customers(spark):
    docs = [
        CUSTOMER,
        {**CUSTOMER, "customer_id": "  "},
        {**CUSTOMER, "customer_id": None},
        {**CUSTOMER, "customer_id": "c2", "birth_date": "2999-01-01"},
        {**CUSTOMER, "customer_id": "c3", "registration_date": "bad"},
        {**CUSTOMER, "customer_id": " c4 "},
    ]
    typed = parse_customers(raw(spark, "customers", *docs))
    out = cleaning.clean_customers(typed, as_of="2025-01-01 00:00:00")
    assert rows(out, "customer_id", "first_name", "gender", "city") == [
        ("c1", "иван", "male", "Big City"), ("c4", "иван", "male", "Big City")]
    assert rows(cleaning.rejects_by_reason(typed, "customers", as_of="2025-01-01 00:00:00")) == [
        ("customers", "birth_date_missing_or_future", 1), ("customers", "blank_key", 2),
        ("customers", "registration_date_missing_or_future", 1)]


def test_clean_and_rejects_are_complementary(spark):
    docs = [{**PURCHASE, "purchase_id": f"o{i}", "total_amount": amount, "purchase_datetime": when}
            for i, (amount, when) in enumerate(
                [(1, "2024-01-01"), (-1, "2024-01-01"), (None, "2024-01-01"), (0, "2026-01-01"), (0, "x"), ("NaN", "2024-01-01")])]
    typed = parse_purchases(raw(spark, "purchases", *docs))
    kept = cleaning.clean_purchases(typed, as_of="2025-01-01 00:00:00", duplicates="keep")
    lost = cleaning.rejected_rows(typed, "purchases", as_of="2025-01-01 00:00:00")
    assert rows(kept, "purchase_id", "payment_method") == [("o0", "cash")]
    assert kept.count() + lost.count() == len(docs)


def test_clean_duplicates(spark):
    typed = parse_purchases(raw(spark, "purchases", PURCHASE, PURCHASE)).unionByName(
        parse_purchases(raw(spark, "purchases", {**PURCHASE, "total_amount": 99})).withColumn(
            "ins_ts", F.lit(datetime(2025, 1, 2))))
    def count(how):
        return cleaning.clean_purchases(typed, as_of="2025-01-01 00:00:00", duplicates=how)
    assert (count("keep").count(), count("exact").count()) == (3, 2)
    assert rows(count("latest"), "total_amount") == [(99.0,)]
    with pytest.raises(ValueError):
        count("some")


def test_clean_stores_columns(spark):
    typed = parse_stores(raw(spark, "stores", {"store_id": "s1", "store_name": "NAME", "last_inventory_date": "2024-01-02"}))
    out = cleaning.clean_stores(typed)
    assert "type" not in out.columns and "store_type_description" not in out.columns
    assert rows(out, "store_name", "last_inventory_date") == [("name", datetime(2024, 1, 2))]


def test_clean_products(spark):
    docs = [{"id": "p1", "price": 0, "name": "Milk"}, {"id": "p2", "price": -0.01}, {"id": "p3"}]
    assert rows(cleaning.clean_products(parse_products(raw(spark, "products", *docs))), "product_id", "name") == [("p1", "milk")]


def test_mask_documents(spark):
    df = spark.createDataFrame(
        [("c1", "A@x.com ", "8 (915) 547-51-95", ("n", "b@x.com", None), ("m", "9155475195")), ("c2", None, None, None, None)],
        "id string, email string, phone string, customer struct<name: string, email: string, phone: string>, "
        "manager struct<name: string, phone: string>")
    out = mask_documents(df, "key")
    assert out.columns == ["id", "customer", "manager", "email_masked", "phone_masked"]
    assert out.schema["customer"].dataType.names == ["name", "email_masked", "phone_masked"]
    assert out.schema["manager"].dataType.names == ["name", "phone"]
    expected = spark.range(1).select(
        mask_value(F.lit("a@x.com"), "key"), mask_phone(F.lit("+79155475195"), "key"), mask_value(F.lit(None), "key")).first()
    first, second = out.orderBy("id").collect()
    assert (first.email_masked, first.phone_masked, first.customer.phone_masked) == tuple(expected)
    assert second.customer is None and second.email_masked == expected[2]
    with_managers = mask_documents(df, "key", structs=("customer", "manager"))
    assert with_managers.schema["manager"].dataType.names == ["name", "phone_masked"]
    assert mask_fields(df, "key", missing="null").orderBy("id").collect()[1].email_masked is None
    assert mask_documents(df.select("id"), "key").columns == ["id"]


def test_messages_hold_nulls_and_plain_text(spark):
    df = spark.createDataFrame([("Имя", None)], "name string, city string")
    message = to_messages(df, "customers").first()
    assert (message.topic, json.loads(message.value)) == ("customers", {"name": "Имя", "city": None})
    assert "Имя" in message.value
