"""One query per operator over the given tables; each is ``(spark, sf_dir) -> DataFrame``.

Dates and times are shown as text and flags as 0/1, so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.lenient import to_instant
from tillflow.functions.masking import mask_value, normalize_phone
from tillflow.operators import clean as cleaning
from tillflow.operators import counting, dashboards, dedup, drift, mart, quality, sketches
from tillflow.operators import features as feat
from tillflow.operators import masking as docmask
from tillflow.operators.items import enrich_items, explode_items
from tillflow.operators.parse import parse, quarantine
from tillflow.operators.upsert import upsert
from tillflow.plans import jobs, star
from tillflow.schemas import DOCUMENTS, ENTITIES
from tillflow.session import shared_dir
from tillflow.sinks.bucketed import buckets_for, write_bucketed
from tillflow.sinks.clustered import lookup, write_clustered
from tillflow.sinks.csv import export_csv
from tillflow.sinks.tables import read_batches, read_latest, refresh_folder, refresh_table, stamped, typed_defaults, write_batch
from tillflow.sinks.topics import publish_files, texts_to_messages, to_messages
from tillflow.sources.documents import readable, unreadable
from tillflow.sources.tables import first_existing
from tillflow.sources.topics import peek, subscribe_files
from tillflow.streaming import panels
from tillflow.streaming.dedup import drop_redelivered
from tillflow.streaming.ingest import compact, current, land_raw, raw_records, start_ingest
from tillflow.streaming.landed import compact_bitmaps, drop_landed
from tillflow.streaming.mart import current_mart, refresh_affected
from tillflow.streaming.shelves import compact_shelf, file_purchases
from tillflow.streaming.states import add_states, compact_states, mart_from_states
from tillflow.streaming.trend import current_trend, start_trend

Query = Callable[[SparkSession, str], DataFrame]

_DOCUMENTS = {
    "customers": star.customer_documents,
    "products": star.product_documents,
    "stores": star.store_documents,
    "purchases": star.purchase_documents,
}

# Feature thresholds on the scale of the given orders.
THRESHOLDS = {"bulk_above": 300000, "low_below": 150000}


def shown(df: DataFrame, **rounded: int) -> DataFrame:
    """Presentation: times and dates as text, booleans as 0/1, named doubles rounded."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif f.name in rounded:
            c = F.round(c, rounded[f.name])
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _mart(df: DataFrame) -> DataFrame:
    return shown(df, total_spent=2, avg_basket=6)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- mart ---------------------------------------------------------------------------------------


def customer_agg(spark, sf_dir):
    return _mart(mart.customer_agg(star.gappy_purchases(spark, sf_dir)))


def customer_mart(spark, sf_dir):
    return _mart(mart.customer_mart(
        star.gappy_purchases(spark, sf_dir), star.repeated_customers(spark, sf_dir), as_of=star.AS_OF))


def customer_mart_sql(spark, sf_dir):
    return _mart(mart.customer_mart_sql(
        star.gappy_purchases(spark, sf_dir), star.repeated_customers(spark, sf_dir), as_of=star.AS_OF))


def customer_mart_full_refresh(spark, sf_dir):
    built = mart.customer_mart(star.purchases(spark, sf_dir), star.customers(spark, sf_dir), as_of=star.AS_OF)
    root = work_dir(spark, "mart")
    # A first version of other rows is replaced by the second; readers only see the one published last.
    refresh_folder(stamped(built.withColumn("purchase_count", F.col("purchase_count") + 1)), root, "1")
    refresh_folder(stamped(built), root, "2", sort_by=["customer_id"])
    return _mart(read_latest(spark, root).drop("ins_ts"))


def conditional_counts(spark, sf_dir):
    paid = F.col("payment_method")
    return counting.conditional_counts(
        star.purchases(spark, sf_dir), ["store_id"], {"cash_count": paid == "cash", "card_count": paid == "card"})


def conditional_distinct(spark, sf_dir):
    kind = F.col("category")
    return counting.conditional_distinct(
        star.feature_lines(spark, sf_dir), ["customer_id"], "product_id",
        {"milk_products": kind == "milk", "fruit_products": kind == "fruits", "bakery_products": kind == "bakery"})


def distinct_stores(spark, sf_dir):
    return counting.distinct_count(star.buyer_items(spark, sf_dir), ["customer_id"], "store_id", "distinct_stores")


# --- features -----------------------------------------------------------------------------------


def _features(spark, sf_dir, **options):
    return shown(feat.customer_features(
        star.purchases(spark, sf_dir), star.feature_lines(spark, sf_dir), as_of=star.AS_OF, **THRESHOLDS, **options))


def features_as_coded(spark, sf_dir):
    return _features(spark, sf_dir)


def features_windowed(spark, sf_dir):
    return _features(spark, sf_dir, windowed=True, unique_purchases=True)


def features_item_weighted(spark, sf_dir):
    header = star.purchases(spark, sf_dir)
    columns = ["purchase_id", "customer_id", "purchase_datetime", "total_amount", "product_id", "category"]
    lines = star.feature_lines(spark, sf_dir).select(*columns)
    bare = quality.orphans(header, star.items(spark, sf_dir), "purchase_id")
    lines = lines.unionByName(bare.select(*columns[:4]), allowMissingColumns=True)
    return shown(feat.customer_features(
        header, lines, as_of=star.AS_OF, item_weighted=True, **THRESHOLDS
    ).select("customer_id", "bulk_buyer", "low_cost_buyer", "buys_bakery"))


def features_from_documents(spark, sf_dir):
    """Documents → typed purchases → items → products → features."""
    typed = parse(star.raw(star.full_purchase_documents(spark, sf_dir), "purchases"), "purchases",
                  ("purchase_id", "customer_id", "total_amount", "purchase_datetime", "items_json"))
    products = star.products(spark, sf_dir).select(
        F.concat(F.lit("prd-"), F.col("product_id").cast("string")).alias("product_id"), "category")
    return shown(jobs.feature_table(typed, products, as_of=star.AS_OF, **THRESHOLDS))


MONTH_ENDS = tuple(f"1995-{m:02d}-{d}" for m, d in enumerate((31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31), 1))


def features_month_ends(spark, sf_dir):
    """The windowed features as of twelve dates, in one pass."""
    return shown(feat.features_at(
        star.purchases(spark, sf_dir), star.feature_lines(spark, sf_dir), MONTH_ENDS, **THRESHOLDS))


def feature_vegetarian(spark, sf_dir):
    return shown(feat.category_flags(star.feature_lines(spark, sf_dir), [feat.VEGETARIAN]))


def feature_profile(spark, sf_dir):
    purchases = star.purchases(spark, sf_dir)
    built = mart.customer_mart(purchases, star.customers(spark, sf_dir), as_of=star.AS_OF)
    return shown(feat.with_profile(feat.purchase_features(purchases, as_of=star.AS_OF, **THRESHOLDS), built))


# --- items and joins ------------------------------------------------------------------------------


def items_enriched(spark, sf_dir):
    items = star.items(spark, sf_dir)
    sold = items.withColumn("product_id", star.lost(F.col("product_id"), 17))
    return enrich_items(sold, star.products(spark, sf_dir), columns=("category", "price"))


def purchase_items_explode(spark, sf_dir):
    typed = parse(star.raw(star.item_documents(spark, sf_dir), "purchases"), "purchases",
                  ("purchase_id", "store_id", "items_json"))
    return explode_items(typed, carry=("purchase_id", "store_id"))


def orphan_purchases(spark, sf_dir):
    items = star.items(spark, sf_dir)
    buyers = quality.orphan_purchases(
        star.purchases(spark, sf_dir).withColumn("customer_id", star.lost(F.col("customer_id"), 9)),
        {"customer_id": star.repeated_customers(spark, sf_dir)})
    lines = quality.orphan_purchases(
        items.withColumns({"product_id": star.lost(F.col("product_id"), 17), "store_id": star.lost(F.col("store_id"), 7)}),
        {"product_id": star.products(spark, sf_dir), "store_id": star.stores(spark, sf_dir)})
    return buyers.unionByName(lines)


def baskets_copartitioned(spark, sf_dir):
    """Lines and purchases stored in the same buckets of the purchase id, joined and summed up where they lie."""
    root, name = work_dir(spark, "buckets"), f"b{uuid.uuid4().hex}"
    items = star.items(spark, sf_dir)
    buckets = buckets_for(items)
    lines = write_bucketed(items, f"{name}_items", f"{root}/items", ["purchase_id"], buckets)
    header = write_bucketed(star.purchases(spark, sf_dir), f"{name}_purchases", f"{root}/purchases", ["purchase_id"], buckets)
    joined = lines.join(header.select("purchase_id", "customer_id", "total_amount"), "purchase_id", "left")
    out = joined.groupBy("purchase_id").agg(
        F.first("customer_id").alias("customer_id"), F.count("*").alias("lines"), F.sum("total_price").alias("items_total"),
        F.max("total_amount").alias("total_amount"))
    return shown(out, items_total=2)


def basket_reconcile(spark, sf_dir):
    return shown(quality.basket_reconcile(star.purchases(spark, sf_dir), star.items(spark, sf_dir)),
                 items_total=2, difference=2)


# --- dashboards and quality -------------------------------------------------------------------------


def revenue_by_store(spark, sf_dir):
    return shown(dashboards.revenue_by_store(star.store_sales(spark, sf_dir), star.stores(spark, sf_dir)), revenue=2)


def revenue_by_region(spark, sf_dir):
    return shown(dashboards.revenue_by_region(
        star.store_sales(spark, sf_dir), star.stores(spark, sf_dir), "region"), revenue=2)


def top10_products(spark, sf_dir):
    return shown(dashboards.top_products(star.items(spark, sf_dir), 10), revenue=2)


def top10_from_states(spark, sf_dir):
    """Best sellers from the lists of eight batches of sales, which name the candidates of an exact second pass."""
    root = work_dir(spark, "best-sellers")
    items = star.items(spark, sf_dir).withColumn("batch", F.pmod(F.xxhash64("purchase_id"), F.lit(8)).cast("int"))
    for batch_id in range(8):
        write_batch(sketches.top_state(items.where(F.col("batch") == batch_id), 200), f"{root}/top", batch_id)
    states = read_batches(spark, f"{root}/top", "key bigint, amount double, cut double")
    return shown(sketches.best_sellers(items, states, 10), revenue=2)


def distinct_buyers_sketch(spark, sf_dir):
    """Buyers per store and year, merged from sketches per store and day: whether the estimate keeps its bound."""
    sales = star.purchases(spark, sf_dir)
    root = work_dir(spark, "sketches")
    day = F.to_date("purchase_datetime").alias("day")
    write_batch(sketches.distinct_states(sales, ["store_id", day], "customer_id"), f"{root}/days", 0)
    days = read_batches(spark, f"{root}/days", "store_id string, day date, rows bigint, sketch binary")
    years = sketches.merge_distinct(days, ["store_id", F.year("day").alias("year")])
    exact = sales.groupBy("store_id", F.year("purchase_datetime").alias("year")).agg(F.count_distinct("customer_id").alias("buyers"))
    both = sketches.distinct_estimate(years, "estimate").join(exact, ["store_id", "year"])
    off = F.abs(F.col("estimate") - F.col("buyers"))
    return shown(both.select("store_id", "year", F.col("rows").alias("purchases"), "buyers",
                             (off <= F.ceil(F.col("buyers") * sketches.relative_error())).alias("within_bound")))


def trend_by_day(spark, sf_dir):
    return shown(dashboards.trend_by_day(star.purchases(spark, sf_dir)), revenue=2)


def customer_activity(spark, sf_dir):
    return shown(dashboards.customer_activity(star.purchases(spark, sf_dir), as_of="2002-01-01 00:00:00"))


def volume_totals(spark, sf_dir):
    return quality.volume_totals({
        "purchases": star.table(spark, sf_dir, "orders"), "stores": star.table(spark, sf_dir, "supplier")})


def duplicate_ratio_alert(spark, sf_dir):
    return shown(quality.duplicate_ratio_alert({
        "customers": (star.table(spark, sf_dir, "customer"), ["c_custkey"]),
        "products": (star.table(spark, sf_dir, "part"), ["p_partkey"]),
        "stores": (star.table(spark, sf_dir, "supplier"), ["s_suppkey"]),
        "purchases": (star.table(spark, sf_dir, "orders"), ["o_orderkey"]),
        "lines": (star.table(spark, sf_dir, "lineitem"), ["l_orderkey"]),
        "items": (star.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
    }), duplicate_ratio=9)


# --- duplicates, keys, upsert -------------------------------------------------------------------------


def distinct_rows(spark, sf_dir):
    return dedup.distinct_rows(star.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


def dedup_by_key(spark, sf_dir):
    return shown(dedup.keep_first(
        star.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


def dedup_latest(spark, sf_dir):
    return shown(dedup.keep_latest(star.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


def drop_blank_keys(spark, sf_dir):
    key = F.col("c_custkey")
    dirty = (F.when(key % 7 == 0, "   ").when(key % 11 == 0, "").when(key % 13 != 0, F.concat(
        F.lit(" \tcus-"), key.cast("string"), F.lit("\n"))))
    return dedup.drop_blank_keys(
        star.table(spark, sf_dir, "customer").select(dirty.alias("customer_id"), "c_name"), ["customer_id"])


def upsert_by_key(spark, sf_dir):
    base = star.products(spark, sf_dir).select("product_id", "name", "price")
    sent = base.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2)))).where(
        (F.col("product_id") % 10 == 0) | (F.col("product_id") % 25 == 1))
    updates = sent.select(
        F.when(F.col("product_id") % 30 == 0, None)
        .when(F.col("product_id") % 25 == 1, F.col("product_id") + 10_000_000_000)
        .otherwise(F.col("product_id")).alias("product_id"),
        "name", (F.col("price") + F.col("seq")).alias("price"), "seq")
    return upsert(base.withColumn("seq", F.lit(0)), updates, ["product_id"], ["seq"])


def peek_limit(spark, sf_dir):
    return shown(peek(star.event_messages(spark, sf_dir), 5, ["sent_at", "value"]))


# --- documents: publish, land, parse, clean -------------------------------------------------------------


def _raw(spark, sf_dir, entity):
    return star.raw(_DOCUMENTS[entity](spark, sf_dir), entity)


def _masked_raw(spark, sf_dir, entity):
    """Raw rows of documents masked as on their way to the topic."""
    documents = docmask.mask_documents(_DOCUMENTS[entity](spark, sf_dir), star.DEMO_KEY)
    return star.raw(documents, entity)


def publish_json_roundtrip(spark, sf_dir):
    root = work_dir(spark, "topics")
    publish_files(to_messages(star.product_documents(spark, sf_dir).drop("delivery"), "products"), root)
    back = spark.read.parquet(root).select("topic", F.from_json("value", DOCUMENTS["products"]).alias("d"))
    return shown(back.select("topic", "d.id", "d.name", F.col("d.kbju.calories").alias("calories"), "d.price",
                             "d.expiry_days", "d.is_organic", F.col("d.manufacturer.inn").alias("inn")))


def raw_landing(spark, sf_dir):
    return shown(land_raw(raw_records(star.event_messages(spark, sf_dir)), work_dir(spark, "raw"), 0).drop("topic"))


def _document_texts(spark, sf_dir, root):
    """Product documents as files of one object per line: with a field nobody declared, some numbers as text, some cut off."""
    key = F.regexp_extract("id", r"\d+", 0).cast("long")
    sent = star.product_documents(spark, sf_dir).drop("price", "kbju", "delivery").withColumns({
        "shelf": F.struct((key % 5).alias("aisle")), "expiry_text": F.when(key % 3 == 0, F.col("expiry_days").cast("string")),
        "expiry_days": F.when(key % 3 != 0, F.col("expiry_days"))})
    whole = F.to_json(F.struct("*"))
    body = F.regexp_replace(whole, '"expiry_text"', '"expiry_days"')  # NULL fields are left out, so one of the two is there
    sent.select(F.when(key % 11 == 5, F.substring(body, 1, 20)).otherwise(body)).write.text(f"{root}/products")
    # Spark's text files do not end in .json, documents do.
    return spark.read.text(f"{root}/products").select(F.col("value").alias("body"))


def publish_documents(spark, sf_dir):
    """What was published, read back, and what was put aside."""
    root = work_dir(spark, "documents")
    texts = _document_texts(spark, sf_dir, root)
    publish_files(texts_to_messages(readable(texts), "products"), f"{root}/topics")
    unreadable(texts, "products").write.parquet(f"{root}/quarantine")
    value = F.col("value")
    number = F.try_variant_get(F.parse_json(value), "$.expiry_days", "variant")
    sent = spark.read.parquet(f"{root}/topics").select(
        F.get_json_object(value, "$.id").alias("id"), F.get_json_object(value, "$.expiry_days").alias("expiry_days"),
        (F.schema_of_variant(number) == "STRING").cast("int").alias("is_text"),
        F.get_json_object(value, "$.shelf.aisle").alias("aisle"), F.lit(None).cast("string").alias("put_aside"))
    aside = spark.read.parquet(f"{root}/quarantine").select(F.col("raw_json").alias("put_aside"))
    return sent.unionByName(aside, allowMissingColumns=True)


def mask_texts(spark, sf_dir):
    """Customer documents whose e-mail is given, null, absent or blank, masked as text."""
    key = F.col("c_custkey")
    mail = F.when(key % 4 == 0, star.email(key)).when(key % 4 == 3, "")
    whole = F.to_json(F.struct(key.alias("id"), mail.alias("email"), F.struct(mail.alias("email")).alias("customer")),
                      {"ignoreNullFields": "false"})
    absent = F.to_json(F.struct(key.alias("id"), F.struct(F.lit(1).alias("kept")).alias("customer")))
    body = star.table(spark, sf_dir, "customer").select(F.when(key % 4 == 2, absent).otherwise(whole).alias("body"))
    masked = body.select(docmask.mask_text(F.col("body"), star.DEMO_KEY).alias("m"))
    return masked.select(
        F.get_json_object("m", "$.id").cast("long").alias("id"), F.get_json_object("m", "$.email_masked").alias("email_masked"),
        F.get_json_object("m", "$.customer.email_masked").alias("nested_masked"),
        F.get_json_object("m", "$.customer.kept").alias("kept"), F.contains("m", F.lit('"email"')).cast("int").alias("plain_left"))


def clean_exact(spark, sf_dir):
    """The SQL definition of clean purchases: only identical rows are one."""
    typed = parse(_masked_raw(spark, sf_dir, "purchases"), "purchases")
    twice = typed.unionAll(typed)
    return shown(cleaning.clean(twice, "purchases", as_of=star.AS_OF, duplicates="exact"))


def csv_export(spark, sf_dir):
    """The mart as dated CSV, read back."""
    target = export_csv(customer_agg(spark, sf_dir), work_dir(spark, "export"), "mart", datetime(1996, 1, 1))
    schema = "customer_id long, purchase_count long, total_spent double, avg_basket double, first_purchase string, " \
             "last_purchase string, distinct_stores long, cash_count long, card_count long, delivery_count long"
    return spark.read.schema(schema).option("header", True).csv(target)


def clustered_lookup(spark, sf_dir):
    """Purchases clustered by customer and time: those of a range of customers, of one customer in a range of days, and
    of single purchase ids, which are not sorted by but have Bloom filters."""
    root = work_dir(spark, "clustered")
    keys = ["customer_id", "purchase_datetime"]
    write_clustered(star.purchases(spark, sf_dir), root, "1", keys, bloom=["purchase_id"], files=16)
    some = lookup(spark, root, keys[:1], [200], [260]).withColumn("asked", F.lit("customers"))
    days = lookup(spark, root, keys, [7, datetime(1993, 1, 1)], [7, datetime(1996, 12, 31)]).withColumn("asked", F.lit("days"))
    single = spark.read.parquet(f"{root}/version=1").where(F.col("purchase_id").isin(1, 77, 500, 1200)).withColumn(
        "asked", F.lit("purchases"))
    return shown(some.unionByName(days).unionByName(single))


def table_fallback(spark, sf_dir):
    """The rows of the first table that exists: the clean one of purchases, the typed one of customers; after a refresh of both."""
    name = f"shop_{uuid.uuid4().hex}"
    bought, known = star.purchases(spark, sf_dir), star.customers(spark, sf_dir)
    refresh_table(bought.withColumn("total_amount", -F.col("total_amount")), f"{name}_purchases")
    for version in (bought.limit(0), bought):
        refresh_table(version, f"clean_{name}_purchases")
    refresh_table(known, f"{name}_customers")
    first = [first_existing(spark, f"clean_{name}_{e}", f"{name}_{e}") for e in ("purchases", "customers")]
    return shown(first[0].unionByName(first[1], allowMissingColumns=True))


def mart_defaults(spark, sf_dir):
    """The tolerant mart of purchases whose amounts are text and that lack two columns, some of unknown buyers, stored without NULLs."""
    narrow = star.purchases(spark, sf_dir).select(
        star.lost(F.col("customer_id"), 3).alias("customer_id"), "purchase_id", "store_id", "purchase_datetime",
        F.when(F.col("purchase_id") % 13 == 0, "n/a").otherwise(F.col("total_amount").cast("string")).alias("total_amount"))
    return _mart(typed_defaults(mart.customer_mart(narrow, star.customers(spark, sf_dir), as_of=star.AS_OF)))


def best_effort_times(spark, sf_dir):
    """Order dates written in many ways, read back."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    ways = ["yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "dd/MM/yyyy", "dd.MM.yyyy", "d MMM yyyy", "MMM d, yyyy",
            "yyyy-MM-dd'T'HH:mm:ss", "d MMM yyyy HH:mm:ss", "yyyyMMddHHmmss"]
    text = F.lit("soon")
    for i, way in enumerate(ways):
        text = F.when(key % (len(ways) + 1) == i, F.date_format(day, way)).otherwise(text)
    return shown(star.table(spark, sf_dir, "orders").select(key.alias("purchase_id"), to_instant(text).alias("at")))


def _drifted(spark, sf_dir, entity):
    """Documents of an entity of which some have one field nobody declared or one of another type."""
    sent = _DOCUMENTS[entity](spark, sf_dir)
    key = {"customers": "loyalty_card_number", "products": "id", "stores": "store_id", "purchases": "purchase_id"}[entity]
    number = F.regexp_extract(key, r"(\d+)$", 1).cast("long")
    if entity == "customers":
        sent = sent.withColumn("nickname", F.when(number % 4 == 0, "Bee"))
    elif entity == "stores":
        sent = sent.withColumn("manager", F.col("manager").withField("age", F.when(number % 2 == 0, 40)))
    else:
        field, every = ("price", 5) if entity == "products" else ("store", 10)
        text = F.when(number % every == 0, F.lit("as text"))
        sent = sent.withColumns({f"{field}_text": text, field: F.when(text.isNull(), F.col(field))})
    rows = star.raw(sent, entity)
    return rows.withColumn("raw_json", F.regexp_replace("raw_json", '"(price|store)_text"', '"$1"'))


def schema_drift(spark, sf_dir):
    """What the documents of all entities hold against their declaration."""
    raw = None
    for entity in ENTITIES:
        part = _drifted(spark, sf_dir, entity)
        raw = part if raw is None else raw.unionByName(part)
    path = work_dir(spark, "shapes")
    drift.shapes(raw).write.parquet(path)
    return drift.drift_report(spark.read.parquet(path))


def quarantine_split(spark, sf_dir):
    return shown(quarantine(raw_records(star.event_messages(spark, sf_dir))))


def _parse(entity):
    return lambda spark, sf_dir: shown(parse(_masked_raw(spark, sf_dir, entity), entity))


def _clean(entity):
    def query(spark, sf_dir):
        typed = parse(_masked_raw(spark, sf_dir, entity), entity)
        return shown(cleaning.clean(typed, entity, as_of=star.AS_OF))
    return query


def rejects_by_reason(spark, sf_dir):
    parts = None
    for entity in ENTITIES:
        typed = parse(_raw(spark, sf_dir, entity), entity)
        part = cleaning.rejects_by_reason(typed, entity, as_of=star.AS_OF)
        parts = part if parts is None else parts.unionByName(part)
    return parts


# --- masking ----------------------------------------------------------------------------------------------


def normalize_phones(spark, sf_dir):
    key = F.col("c_custkey")
    return star.table(spark, sf_dir, "customer").select(
        key.alias("customer_id"), star.phone(key).alias("phone"), normalize_phone(star.phone(key)).alias("normalized"))


def mask_hmac(spark, sf_dir):
    return star.table(spark, sf_dir, "documents").select(
        "doc_id", mask_value(F.col("text"), star.DEMO_KEY).alias("text_masked"))


def mask_customers(spark, sf_dir):
    documents = star.customer_documents(spark, sf_dir).select("loyalty_card_number", "email", "phone")
    return docmask.mask_fields(documents, star.DEMO_KEY)


def mask_nested(spark, sf_dir):
    people = star.customer_documents(spark, sf_dir).select(
        F.col("loyalty_card_number").alias("card"), F.struct("first_name", "email", "phone").alias("customer"))
    return docmask.mask_struct(people, "customer", star.DEMO_KEY).select("card", "customer.*")


# --- streams: run to the end of the input, then read what they wrote -----------------------------------------


def _stream_deliveries(spark, sf_dir, root, entities, after_batch=None, **other_documents):
    """Publish the first deliveries and run the stream to their end, then the same for the second ones."""
    for delivery in (0, 1):
        for entity in entities:
            sent = {**_DOCUMENTS, **other_documents}[entity](spark, sf_dir).where(F.col("delivery") == delivery).drop("delivery")
            messages = to_messages(docmask.mask_documents(sent, star.DEMO_KEY), entity)
            publish_files(messages, f"{root}/topics")
        stream = subscribe_files(spark, f"{root}/topics")
        start_ingest(stream, root, f"{root}/checkpoint", as_of=star.AS_OF, after_batch=after_batch).awaitTermination()


def stream_ingest_clean(spark, sf_dir):
    """Topic → raw → typed → clean over two micro-batches; the repeats meet across batches."""
    root = work_dir(spark, "ingest")
    _stream_deliveries(spark, sf_dir, root, ["purchases"])
    return shown(current(spark, root, "purchases").drop("ins_ts"))


def stream_compacted(spark, sf_dir):
    """The same with the first batch compacted before the second one comes."""
    root = work_dir(spark, "compacted")
    _stream_deliveries(spark, sf_dir, root, ["purchases"],
                       after_batch=lambda session, batch_id: batch_id == 0 and compact(session, root, "purchases"))
    return shown(current(spark, root, "purchases").drop("ins_ts"))


def stream_mart_refresh(spark, sf_dir):
    """The mart after every batch has refreshed the customers it touched."""
    root = work_dir(spark, "mart-stream")
    _stream_deliveries(
        spark, sf_dir, root, ["customers", "purchases"],
        after_batch=lambda session, batch_id: refresh_affected(session, batch_id, root, as_of=star.AS_OF))
    return _mart(current_mart(spark, root, as_of=star.AS_OF))


def stream_mart_states(spark, sf_dir):
    """The mart merged from states; between the deliveries states and shelf are compacted, then purchases move."""
    root = work_dir(spark, "mart-states")

    def add(session, batch_id):
        add_states(session, batch_id, root)
        if batch_id == 0:
            compact_states(session, root)
            compact_shelf(session, root)

    _stream_deliveries(spark, sf_dir, root, ["customers", "purchases"], after_batch=add, purchases=star.moved_purchase_documents)
    return _mart(mart_from_states(spark, root, as_of=star.AS_OF))


def stream_panels(spark, sf_dir):
    """Totals, stores, days and customers, live over two deliveries of which the second moves purchases and changes amounts."""
    root = work_dir(spark, "panels")

    def add(session, batch_id):
        panels.add_changes(file_purchases(session, batch_id, root), batch_id, root)
        panels.start_panels(panels.read_changes(session, root), root, f"{root}/panels-checkpoint").awaitTermination()
        if batch_id == 0:
            panels.compact_panels(session, root)

    _stream_deliveries(spark, sf_dir, root, ["purchases"], after_batch=add, purchases=star.moved_purchase_documents)
    parts = [panels.live_totals(spark, root).select(F.lit("total").alias("panel"), F.lit("").alias("key"), "purchases", "revenue"),
             panels.live_stores(spark, root).select(F.lit("store").alias("panel"), F.col("store_id").alias("key"), "purchases", "revenue"),
             panels.live_days(spark, root).select(F.lit("day").alias("panel"), F.col("day").cast("string").alias("key"), "purchases", "revenue"),
             panels.live_activity(spark, root).select(
                 F.lit("customer").alias("panel"), F.col("customer_id").alias("key"), "purchases", "active_days",
                 F.date_format("last_day", "yyyy-MM-dd").alias("last_day"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return shown(out, revenue=2)


def _orders_stream(spark, sf_dir):
    schema = star.table(spark, sf_dir, "orders").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)


def _finish(stream, root):
    (stream.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def stream_redelivery_dedup(spark, sf_dir):
    schema = star.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    again = events.withColumn("delivery", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).where(
        (F.col("delivery") == 0) | (F.col("event_id") % 3 == 0))
    kept = drop_redelivered(again.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id"),
                            ["event_id"], "ts", "60 days")
    return _finish(kept.select("event_id", "user_id"), work_dir(spark, "dedup-stream"))


def landed_redelivery(spark, sf_dir):
    """Four batches of events, each with copies of a third of all events landed before: copies are dropped as they come."""
    root = work_dir(spark, "landed")
    events = star.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    dealt = events.withColumn("turn", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    for batch_id in range(4):
        again = dealt.where((F.col("turn") < batch_id) & (F.col("event_id") % 3 == 0))
        sent = dealt.where(F.col("turn") == batch_id).unionByName(again).drop("turn")
        drop_landed(sent, batch_id, root, ["event_id"], "ts")
        if batch_id == 1:
            compact_bitmaps(spark, root)
    return read_batches(spark, f"{root}/kept", "event_id bigint, ts timestamp, user_id bigint").select("event_id", "user_id")


def stream_trend_by_day(spark, sf_dir):
    orders = _orders_stream(spark, sf_dir).select(
        F.col("o_orderdate").cast("timestamp").alias("purchase_datetime"), F.col("o_totalprice").alias("total_amount"))
    root = work_dir(spark, "trend-stream")
    start_trend(orders, root, f"{root}/checkpoint", "3650 days").awaitTermination()
    return shown(current_trend(spark, root), revenue=2)


QUERIES: dict[str, Query] = {
    "customer_agg": customer_agg,
    "customer_mart": customer_mart,
    "customer_mart_sql": customer_mart_sql,
    "customer_mart_full_refresh": customer_mart_full_refresh,
    "conditional_counts": conditional_counts,
    "conditional_distinct": conditional_distinct,
    "distinct_stores": distinct_stores,
    "features_as_coded": features_as_coded,
    "features_windowed": features_windowed,
    "features_item_weighted": features_item_weighted,
    "features_from_documents": features_from_documents,
    "features_month_ends": features_month_ends,
    "feature_vegetarian": feature_vegetarian,
    "feature_profile": feature_profile,
    "items_enriched": items_enriched,
    "purchase_items_explode": purchase_items_explode,
    "orphan_purchases": orphan_purchases,
    "basket_reconcile": basket_reconcile,
    "baskets_copartitioned": baskets_copartitioned,
    "revenue_by_store": revenue_by_store,
    "revenue_by_region": revenue_by_region,
    "top10_products": top10_products,
    "top10_from_states": top10_from_states,
    "distinct_buyers_sketch": distinct_buyers_sketch,
    "trend_by_day": trend_by_day,
    "customer_activity": customer_activity,
    "volume_totals": volume_totals,
    "duplicate_ratio_alert": duplicate_ratio_alert,
    "distinct_rows": distinct_rows,
    "dedup_by_key": dedup_by_key,
    "dedup_latest": dedup_latest,
    "drop_blank_keys": drop_blank_keys,
    "upsert_by_key": upsert_by_key,
    "peek_limit": peek_limit,
    "publish_json_roundtrip": publish_json_roundtrip,
    "raw_landing": raw_landing,
    "publish_documents": publish_documents,
    "mask_texts": mask_texts,
    "clean_exact": clean_exact,
    "csv_export": csv_export,
    "clustered_lookup": clustered_lookup,
    "table_fallback": table_fallback,
    "mart_defaults": mart_defaults,
    "best_effort_times": best_effort_times,
    "quarantine_split": quarantine_split,
    "schema_drift": schema_drift,
    **{f"parse_{e}": _parse(e) for e in ENTITIES},
    **{f"clean_{e}": _clean(e) for e in ENTITIES},
    "rejects_by_reason": rejects_by_reason,
    "normalize_phone": normalize_phones,
    "mask_hmac": mask_hmac,
    "mask_customers": mask_customers,
    "mask_nested": mask_nested,
    "stream_ingest_clean": stream_ingest_clean,
    "stream_compacted": stream_compacted,
    "stream_mart_refresh": stream_mart_refresh,
    "stream_mart_states": stream_mart_states,
    "stream_panels": stream_panels,
    "stream_redelivery_dedup": stream_redelivery_dedup,
    "landed_redelivery": landed_redelivery,
    "stream_trend_by_day": stream_trend_by_day,
}
