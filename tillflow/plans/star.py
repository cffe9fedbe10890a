"""The given star-schema tables seen as retail entities.

Orders are purchases, order lines are items, parts are products, suppliers are stores. Documents
for the JSON layer are built from the same rows, with gaps and repeats put in by rules on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.features import category_group

AS_OF = "1996-01-01 00:00:00"
DEMO_KEY = "only-for-the-given-tables"

GROUPS = {"economy": "bakery", "promo": "meat", "medium": "milk", "small": "fruits", "large": "veggies"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Share the rows evenly among all cores before costly JSON work, however the files are cut."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _payment() -> Column:
    return F.when(F.col("o_orderstatus") == "F", "cash").when(F.col("o_orderstatus") == "O", "card").otherwise("gift")


def _delivered() -> Column:
    return F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as purchases; the order priority stands for the sales point."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("purchase_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("store_id"),
        F.col("o_totalprice").alias("total_amount"),
        _payment().alias("payment_method"),
        _delivered().cast("int").alias("is_delivery"),
        F.col("o_orderdate").alias("purchase_datetime"),
    )


def gappy_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of which some have no amount and some no customer."""
    key = F.col("purchase_id")
    return purchases(spark, sf_dir).withColumns({
        "total_amount": F.when(key % 101 != 0, F.col("total_amount")),
        "customer_id": F.when(key % 211 != 0, F.col("customer_id")),
    })


def _registered(key: Column) -> Column:
    return (F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.pmod(key * 37, F.lit(730)).cast("int")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        _registered(F.col("c_custkey")).alias("registration_date"),
        (F.col("c_acctbal") > 5000).cast("int").alias("is_loyalty_member"),
    )


def _deliveries(key: Column, every: int) -> Column:
    """0 for each row, and 1 again for every n-th key: a row that was sent twice."""
    return F.explode(F.when(key % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def lost(key: Column, every: int) -> Column:
    """A key of which every n-th value is one that no lookup table has."""
    return F.when(key % every == 0, -key - 1).otherwise(key)


def repeated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of which every twentieth comes twice, changed."""
    key = F.col("customer_id")
    sent = customers(spark, sf_dir).withColumn("delivery", _deliveries(key, 20))
    return sent.select(
        "customer_id",
        (F.col("registration_date") + F.make_dt_interval(F.col("delivery") * 5)).alias("registration_date"),
        F.when(F.col("delivery") == 1, 1 - F.col("is_loyalty_member"))
        .otherwise(F.col("is_loyalty_member")).alias("is_loyalty_member"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        category_group(F.col("p_type"), GROUPS).alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stores, with nation and region names."""
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    named = supplier.join(nation, "n_nationkey", "left").join(table(spark, sf_dir, "region"), "r_regionkey", "left")
    return named.select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as purchase items."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("purchase_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_price"),
    )


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales of a store."""
    return items(spark, sf_dir).select("purchase_id", "store_id", F.col("total_price").alias("total_amount"))


def buyer_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the buyer and the time of their purchase."""
    header = purchases(spark, sf_dir).select("purchase_id", "customer_id", "purchase_datetime", "total_amount")
    return items(spark, sf_dir).join(header, "purchase_id")


def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buyer_items(spark, sf_dir).join(products(spark, sf_dir).select("product_id", "category"), "product_id", "left")


# --- documents --------------------------------------------------------------------------------


def _text(c: Column) -> Column:
    return c.cast("string")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def phone(key: Column) -> Column:
    """Numbers written in six ways, empty and missing among them."""
    ten = _text(key + 9000000000)
    spaced = F.concat(
        F.lit("8 ("), F.substring(ten, 1, 3), F.lit(") "), F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4)
    )
    return (
        F.when(key % 6 == 0, spaced)
        .when(key % 6 == 1, F.concat(F.lit("+7 "), ten))
        .when(key % 6 == 2, ten)
        .when(key % 6 == 3, "")
        .when(key % 6 == 5, F.concat(F.lit("ext. "), _text(key)))
    )


def email(key: Column) -> Column:
    return F.concat(F.lit("  C"), _text(key), F.lit("@Example.COM "))


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer documents with ``delivery``; a second delivery has the other loyalty flag."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(key * 11, F.lit(20000)).cast("int"))
    place = [
        F.lit("Homeland").alias("country"),
        F.col("c_mktsegment").alias("city"),
        F.concat(F.lit("Street "), _text(nation)).alias("street"),
        _text(nation).alias("house"),
    ]
    postal = F.lpad(_text(nation), 6, "0").alias("postal_code")
    return spread(table(spark, sf_dir, "customer")).withColumn("delivery", _deliveries(key, 10)).select(
        F.when(key % 97 == 0, "  ").otherwise(F.concat(F.lit("cus-"), _text(key))).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        email(key).alias("email"),
        phone(key).alias("phone"),
        F.date_format(born, "yyyy-MM-dd").alias("birth_date"),
        F.when(nation % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(key % 89 == 0, "not a date").otherwise(_iso(_registered(key))).alias("registration_date"),
        ((F.col("c_acctbal") > 5000) != (F.col("delivery") == 1)).alias("is_loyalty_member"),
        F.lpad(_text(key), 10, "0").alias("loyalty_card_number"),
        F.struct(*place, postal, F.struct(
            F.lit(1.5).alias("latitude"), F.lit(-2.5).alias("longitude")).alias("coordinates")
        ).alias("purchase_location"),
        F.struct(*place, F.lit("1").alias("apartment"), postal).alias("delivery_address"),
        "delivery",
    )


def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return spread(table(spark, sf_dir, "part")).withColumn("delivery", _deliveries(key, 10)).select(
        F.concat(F.lit("prd-"), _text(key)).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("group"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("description"),
        F.struct(
            (size * 10.5).alias("calories"), (size / 2).alias("protein"),
            (size / 4).alias("fat"), (size * 2.0).alias("carbohydrates"),
        ).alias("kbju"),
        F.when(key % 50 == 7, -F.col("p_retailprice")).otherwise(F.col("p_retailprice") + F.col("delivery")).alias("price"),
        F.lit("PCS").alias("unit"),
        F.lit("Homeland").alias("origin_country"),
        (size.cast("bigint") * 2500).alias("expiry_days"),
        (size % 2 == 0).alias("is_organic"),
        F.lpad(_text(key), 13, "0").alias("barcode"),
        F.struct(
            F.col("p_brand").alias("name"), F.lit("Homeland").alias("country"),
            F.lit("https://maker.example").alias("website"), F.lpad(_text(key), 10, "7").alias("inn"),
        ).alias("manufacturer"),
        "delivery",
    )


def store_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, rich = F.col("s_suppkey"), F.col("s_acctbal") > 5000
    counted = F.date_add(F.lit("1995-06-01").cast("date"), F.pmod(key, F.lit(200)).cast("int"))
    return table(spark, sf_dir, "supplier").withColumn("delivery", _deliveries(key, 10)).select(
        F.concat(F.lit("store-"), _text(key)).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.when(rich, "Large Shops").otherwise("Small Shops").alias("store_network"),
        F.lit("A shop").alias("store_type_description"),
        F.lit("offline").alias("type"),
        F.array(F.lit("bakery"), F.lit("milk")).alias("categories"),
        F.struct(
            F.concat(F.lit("Manager "), _text(key)).alias("name"), phone(key).alias("phone"), email(key).alias("email")
        ).alias("manager"),
        F.struct(
            F.lit("Homeland").alias("country"), F.concat(F.lit("City "), _text(F.col("s_nationkey"))).alias("city"),
            F.lit("Main Street").alias("street"), _text(F.col("s_nationkey")).alias("house"),
            F.lpad(_text(key), 6, "0").alias("postal_code"),
        ).alias("location"),
        rich.alias("accepts_online_orders"),
        (F.col("delivery") == 1).alias("delivery_available"),
        (key % 3 == 0).alias("warehouse_connected"),
        F.when(key % 7 != 0, F.date_format(counted, "yyyy-MM-dd")).otherwise("unknown").alias("last_inventory_date"),
        "delivery",
    )


def purchase_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase documents without their items, see :func:`item_documents`."""
    key = F.col("o_orderkey")
    return spread(table(spark, sf_dir, "orders")).withColumn("delivery", _deliveries(key, 10)).select(
        F.concat(F.lit("ord-"), _text(key)).alias("purchase_id"),
        F.struct(F.concat(F.lit("cus-"), _text(F.col("o_custkey"))).alias("customer_id")).alias("customer"),
        F.struct(F.col("o_orderpriority").alias("store_id")).alias("store"),
        F.array().cast("array<string>").alias("items"),
        F.when(key % 100 == 3, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice") + F.col("delivery")).alias("total_amount"),
        F.initcap(_payment()).alias("payment_method"),
        _delivered().alias("is_delivery"),
        F.struct(
            F.lit("Homeland").alias("country"), F.lit("Town").alias("city"),
            F.when(key % 4 != 0, F.lit("Long Street")).alias("street"),
            _text(key % 100).alias("house"), _text(key % 10).alias("apartment"), F.lit("000001").alias("postal_code"),
        ).alias("delivery_address"),
        F.when(key % 103 == 0, "no date").otherwise(_iso(F.col("o_orderdate"))).alias("purchase_datetime"),
        "delivery",
    )


def moved_purchase_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase documents whose second delivery names another customer and store in a third of the cases."""
    key = F.substring_index("purchase_id", "-", -1).cast("bigint")
    moved = (F.col("delivery") == 1) & (key % 30 == 0)
    other = F.concat(F.lit("cus-"), _text(F.substring_index("customer.customer_id", "-", -1).cast("bigint") + 1))
    return purchase_documents(spark, sf_dir).withColumns({
        "customer": F.struct(F.when(moved, other).otherwise(F.col("customer.customer_id")).alias("customer_id")),
        "store": F.struct(F.when(moved, "0-MOVED").otherwise(F.col("store.store_id")).alias("store_id"))})


def full_purchase_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase documents with their own order lines as items; an order has a handful of lines."""
    item = F.struct(
        F.concat(F.lit("prd-"), _text(F.col("l_partkey"))).alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("total_price"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(item).alias("items"))
    return table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").select(
        F.concat(F.lit("ord-"), _text(F.col("o_orderkey"))).alias("purchase_id"),
        F.struct(F.concat(F.lit("cus-"), _text(F.col("o_custkey"))).alias("customer_id")).alias("customer"),
        F.struct(F.col("o_orderpriority").alias("store_id")).alias("store"),
        "items", F.col("o_totalprice").alias("total_amount"), _payment().alias("payment_method"),
        _delivered().alias("is_delivery"), _iso(F.col("o_orderdate")).alias("purchase_datetime"), F.lit(0).alias("delivery"))


def item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One purchase document per order line; a line of more than 25 pieces is split over two items."""
    line = F.col("l_linenumber")

    def item(quantity: Column) -> Column:
        price = F.col("l_extendedprice") / F.col("l_quantity")
        return F.struct(
            F.concat(F.lit("prd-"), _text(F.col("l_partkey"))).alias("product_id"),
            F.concat(F.lit("Part "), _text(F.col("l_partkey"))).alias("name"),
            F.col("l_returnflag").alias("category"),
            quantity.cast("bigint").alias("quantity"),
            F.lit("PCS").alias("unit"),
            price.alias("price_per_unit"),
            (price * quantity).alias("total_price"),
        )

    quantity = F.col("l_quantity")
    return spread(table(spark, sf_dir, "lineitem")).select(
        F.concat(F.lit("ord-"), _text(F.col("l_orderkey")), F.lit("-"), _text(line)).alias("purchase_id"),
        F.struct(F.lit("cus-0").alias("customer_id")).alias("customer"),
        F.struct(F.concat(F.lit("store-"), _text(F.col("l_suppkey"))).alias("store_id")).alias("store"),
        F.when(quantity > 25, F.array(item(F.lit(25)), item(quantity - 25))).otherwise(F.array(item(quantity))).alias("items"),
        F.col("l_extendedprice").alias("total_amount"),
        F.lit("card").alias("payment_method"),
        F.lit(False).alias("is_delivery"),
        _iso(F.col("l_shipdate")).alias("purchase_datetime"),
        F.lit(0).alias("delivery"),
    )


def raw(documents: DataFrame, entity: str) -> DataFrame:
    """Raw rows of documents; a second delivery arrives one hour after the first."""
    body = [F.col(f"`{c}`") for c in documents.columns if c != "delivery"]
    arrived = F.lit("1995-12-31 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("delivery"))
    return documents.select(
        arrived.alias("ts"), F.lit(entity).alias("source"), F.to_json(F.struct(*body)).alias("raw_json")
    )


_EVENT_TOPICS = {"purchase": "purchases", "signup": "customers", "click": "products", "view": "stores"}


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages; every seventh is cut off in the middle."""
    topic = F.lit(None).cast("string")
    for event, name in _EVENT_TOPICS.items():
        topic = F.when(F.col("event_type") == event, name).otherwise(topic)
    return table(spark, sf_dir, "events").select(
        F.coalesce(topic, F.col("event_type")).alias("topic"),
        F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 4)).otherwise(F.col("props")).alias("value"),
        F.col("ts").cast("timestamp").alias("sent_at"),
    )
