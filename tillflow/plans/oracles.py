"""The same results in plain SQL over the given tables, written independently of the operators."""

from __future__ import annotations

from tillflow.plans.star import DEMO_KEY

_PURCHASES = """
SELECT o_orderkey AS purchase_id, o_custkey AS customer_id, o_orderpriority AS store_id,
       o_totalprice AS total_amount,
       CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'card' ELSE 'gift' END AS payment_method,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_delivery,
       o_orderdate AS purchase_datetime
FROM orders"""

_GAPPY = f"""
SELECT purchase_id, CASE WHEN purchase_id % 211 <> 0 THEN customer_id END AS customer_id, store_id,
       CASE WHEN purchase_id % 101 <> 0 THEN total_amount END AS total_amount,
       payment_method, is_delivery, purchase_datetime
FROM ({_PURCHASES})"""

_CUSTOMERS = """
SELECT c_custkey AS customer_id,
       TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey * 37 % 730 AS INTEGER)) AS registration_date,
       CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS is_loyalty_member
FROM customer"""

_REPEATED = f"""
SELECT customer_id, registration_date + to_days(CAST(d * 5 AS INTEGER)) AS registration_date,
       CASE WHEN d = 1 THEN 1 - is_loyalty_member ELSE is_loyalty_member END AS is_loyalty_member
FROM ({_CUSTOMERS}), (VALUES (0), (1)) v(d)
WHERE d = 0 OR customer_id % 20 = 0"""

_CATEGORY = """CASE lower(p_type) WHEN 'economy' THEN 'bakery' WHEN 'promo' THEN 'meat' WHEN 'medium' THEN 'milk'
     WHEN 'small' THEN 'fruits' WHEN 'large' THEN 'veggies' ELSE lower(p_type) END"""

_LINES = f"""
SELECT l_orderkey AS purchase_id, o_custkey AS customer_id, o_orderdate AS purchase_datetime,
       o_totalprice AS total_amount, l_partkey AS product_id, l_suppkey AS store_id, {_CATEGORY} AS category
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey"""

_AS_OF = "TIMESTAMP '1996-01-01 00:00:00'"


def _time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _totals(source: str, count: str, amount: str) -> str:
    return f"""
SELECT customer_id, {count} AS purchase_count, round(sum({amount}), 2) AS total_spent,
       round(avg({amount}), 6) AS avg_basket,
       min(purchase_datetime) AS first_purchase, max(purchase_datetime) AS last_purchase,
       count(DISTINCT store_id) AS distinct_stores,
       CAST(sum(CASE WHEN payment_method = 'cash' THEN 1 ELSE 0 END) AS BIGINT) AS cash_count,
       CAST(sum(CASE WHEN payment_method = 'card' THEN 1 ELSE 0 END) AS BIGINT) AS card_count,
       CAST(sum(is_delivery) AS BIGINT) AS delivery_count
FROM ({source}) GROUP BY customer_id"""


_TOLERANT = _totals(f"SELECT * FROM ({_GAPPY}) WHERE customer_id IS NOT NULL", "count(purchase_id)",
                    "coalesce(total_amount, 0)")

_TOTAL_COLUMNS = f"""p.customer_id, purchase_count, total_spent, avg_basket,
       {_time('first_purchase')} AS first_purchase, {_time('last_purchase')} AS last_purchase,
       distinct_stores, cash_count, card_count, delivery_count"""


def _mart(totals: str, customers: str, is_new: str) -> str:
    return f"""
SELECT {_TOTAL_COLUMNS},
       CASE WHEN {is_new} THEN 1 ELSE 0 END AS new_customer,
       coalesce(is_loyalty_member, 0) AS is_loyalty_member,
       {_time('registration_date')} AS registration_date
FROM ({totals}) p LEFT JOIN ({customers}) c ON p.customer_id = c.customer_id"""


_FIRST_ROW = f"""
SELECT customer_id, registration_date, is_loyalty_member FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY registration_date) AS r FROM ({_REPEATED})
) WHERE r = 1"""

_ELAPSED = f"registration_date > {_AS_OF} - INTERVAL 30 DAY"
_CALENDAR = "date_diff('day', CAST(registration_date AS DATE), DATE '1996-01-01') < 30"


def _flag(condition: str, name: str, negate: bool = False) -> str:
    hit, miss = (0, 1) if negate else (1, 0)
    return f"CASE WHEN count(DISTINCT CASE WHEN {condition} THEN product_id END) > 0 THEN {hit} ELSE {miss} END AS {name}"


def _within(days: int) -> str:
    return f"purchase_datetime BETWEEN {_AS_OF} - INTERVAL {days} DAY AND {_AS_OF}"


def _bit(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {name}"


def _purchase_features(reference: str) -> str:
    return f"""
SELECT customer_id, {_bit("count(DISTINCT purchase_id) > 2", "recurrent_buyer")},
       {_bit("avg(total_amount) > 300000", "bulk_buyer")}, {_bit("avg(total_amount) < 150000", "low_cost_buyer")},
       {_bit(f"max(purchase_datetime) > {_AS_OF}", "active_today")},
       {_bit(f"{reference}(purchase_datetime) < {_AS_OF} - INTERVAL 30 DAY", "inactive_30d")}
FROM ({_PURCHASES}) GROUP BY customer_id"""


def _features(reference: str, windowed: bool) -> str:
    milk, fruit, veg = (f" AND {_within(d)}" if windowed else "" for d in (30, 14, 14))
    return f"""
SELECT p.*, coalesce(bought_milk_last_30d, 0) AS bought_milk_last_30d,
       coalesce(bought_fruits_last_14d, 0) AS bought_fruits_last_14d,
       coalesce(not_bought_veggies_14d, 1) AS not_bought_veggies_14d, coalesce(buys_bakery, 0) AS buys_bakery
FROM ({_purchase_features(reference)}) p LEFT JOIN (
  SELECT customer_id, {_flag(f"category = 'milk'{milk}", "bought_milk_last_30d")},
         {_flag(f"category = 'fruits'{fruit}", "bought_fruits_last_14d")},
         {_flag(f"category = 'veggies'{veg}", "not_bought_veggies_14d", negate=True)},
         {_flag("category = 'bakery'", "buys_bakery")}
  FROM ({_LINES}) GROUP BY customer_id
) f ON p.customer_id = f.customer_id"""


# --- documents ------------------------------------------------------------------------------------


def _hmac(text: str, key: str = DEMO_KEY) -> str:
    block = key.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in block).hex() for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"


def _phone(k: str) -> str:
    ten = f"CAST({k} + 9000000000 AS VARCHAR)"
    return f"""CASE WHEN {k} % 6 = 0 THEN '8 (' || substr({ten}, 1, 3) || ') ' || substr({ten}, 4, 3) || '-' || substr({ten}, 7, 4)
     WHEN {k} % 6 = 1 THEN '+7 ' || {ten} WHEN {k} % 6 = 2 THEN {ten} WHEN {k} % 6 = 3 THEN ''
     WHEN {k} % 6 = 5 THEN 'ext. ' || CAST({k} AS VARCHAR) END"""


def _normal(k: str) -> str:
    """The normalised number, worked out from how the number was made rather than from its text."""
    ten, short = f"CAST({k} + 9000000000 AS VARCHAR)", f"CAST({k} AS VARCHAR)"
    full = f"CASE WHEN length({short}) = 10 THEN '+7' || {short} ELSE '+' || {short} END"
    return f"CASE WHEN {k} % 6 IN (0, 1, 2) THEN '+7' || {ten} WHEN {k} % 6 = 5 THEN {full} ELSE '' END"


_D = "(VALUES (0), (1)) v(d)"
_ARRIVED = "strftime(TIMESTAMP '1995-12-31 00:00:00' + to_hours(CAST(d AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS ins_ts"

_BORN = "DATE '1950-01-01' + CAST(c_custkey * 11 % 20000 AS INTEGER)"
_REGISTERED = ("CASE WHEN c_custkey % 89 <> 0 THEN TIMESTAMP '1995-01-01 00:00:00' + "
               "to_days(CAST(c_custkey * 37 % 730 AS INTEGER)) END")

_CUSTOMER_DOCS = f"""
SELECT c_custkey AS k, d, CASE WHEN c_custkey % 97 = 0 THEN '  ' ELSE 'cus-' || c_custkey END AS customer_id,
       c_name AS first_name, c_mktsegment AS last_name,
       CASE WHEN c_nationkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       {_BORN} AS birth_date, {_REGISTERED} AS registration_date,
       CASE WHEN (c_acctbal > 5000) <> (d = 1) THEN 1 ELSE 0 END AS is_loyalty_member,
       lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS loyalty_card_number,
       c_mktsegment AS city, 'Street ' || c_nationkey AS street, CAST(c_nationkey AS VARCHAR) AS house,
       lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS postal_code, {_ARRIVED}
FROM customer, {_D} WHERE d = 0 OR c_custkey % 10 = 0"""

_CUSTOMER_TAIL = f"""strftime(birth_date, '%Y-%m-%d') AS birth_date, {_time('registration_date')} AS registration_date,
       is_loyalty_member, loyalty_card_number, city, street, house, postal_code, ins_ts"""

_PRODUCT_DOCS = f"""
SELECT p_partkey AS k, d, 'prd-' || p_partkey AS product_id, p_name AS name, p_type AS category,
       p_brand || ' ' || p_name AS description, CAST(p_size AS DOUBLE) * 10.5::DOUBLE AS calories,
       CAST(p_size AS DOUBLE) / 2 AS protein, CAST(p_size AS DOUBLE) / 4 AS fat, CAST(p_size AS DOUBLE) * 2 AS carbohydrates,
       CASE WHEN p_partkey % 50 = 7 THEN -p_retailprice ELSE p_retailprice + d END AS price,
       'PCS' AS unit, 'Homeland' AS origin_country,
       CASE WHEN p_size * 2500 <= 65535 THEN p_size * 2500 END AS expiry_days,
       CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS is_organic, lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS barcode,
       p_brand AS manufacturer_name, 'Homeland' AS manufacturer_country,
       'https://maker.example' AS manufacturer_website, lpad(CAST(p_partkey AS VARCHAR), 10, '7') AS manufacturer_inn,
       {_ARRIVED}
FROM part, {_D} WHERE d = 0 OR p_partkey % 10 = 0"""

_STORE_DOCS = f"""
SELECT s_suppkey AS k, d, 'store-' || s_suppkey AS store_id, s_name AS store_name,
       CASE WHEN s_acctbal > 5000 THEN 'Large Shops' ELSE 'Small Shops' END AS store_network,
       'A shop' AS store_type_description, 'offline' AS type, 'City ' || s_nationkey AS city,
       'Main Street' AS street, CAST(s_nationkey AS VARCHAR) AS house,
       lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS postal_code, 'Manager ' || s_suppkey AS manager_name,
       {_phone('s_suppkey')} AS manager_phone, '  C' || s_suppkey || '@Example.COM ' AS manager_email,
       CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS accepts_online_orders,
       CASE WHEN d = 1 THEN 1 ELSE 0 END AS delivery_available,
       CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS warehouse_connected,
       CASE WHEN s_suppkey % 7 <> 0 THEN DATE '1995-06-01' + CAST(s_suppkey % 200 AS INTEGER) END AS last_inventory_date,
       {_ARRIVED}
FROM supplier, {_D} WHERE d = 0 OR s_suppkey % 10 = 0"""

_PURCHASE_DOCS = f"""
SELECT o_orderkey AS k, d, 'ord-' || o_orderkey AS purchase_id, 'cus-' || o_custkey AS customer_id,
       o_orderpriority AS store_id,
       CASE WHEN o_orderkey % 100 = 3 THEN -o_totalprice ELSE o_totalprice + d END AS total_amount,
       CASE o_orderstatus WHEN 'F' THEN 'Cash' WHEN 'O' THEN 'Card' ELSE 'Gift' END AS payment_method,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_delivery,
       CASE WHEN o_orderkey % 103 <> 0 THEN o_orderdate END AS purchase_datetime,
       'Homeland' AS delivery_country, 'Town' AS delivery_city,
       CASE WHEN o_orderkey % 4 <> 0 THEN 'Long Street' END AS delivery_street,
       CAST(o_orderkey % 100 AS VARCHAR) AS delivery_house, CAST(o_orderkey % 10 AS VARCHAR) AS delivery_apartment,
       '000001' AS delivery_postal_code, '[]' AS items_json, {_ARRIVED}
FROM orders, {_D} WHERE d = 0 OR o_orderkey % 10 = 0"""


def _last(docs: str, keep: str) -> str:
    return f"""SELECT * FROM ({docs}) WHERE ({keep}) AND d = CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END"""


_GOOD_CUSTOMERS = f"k % 97 <> 0 AND birth_date <= DATE '1996-01-01' AND registration_date <= {_AS_OF}"
_GOOD_PURCHASES = f"total_amount >= 0 AND purchase_datetime <= {_AS_OF}"

_DELIVERY = """delivery_country, delivery_city, delivery_street, delivery_house, delivery_apartment,
       delivery_postal_code, items_json"""


def _lineitem_by_key(first: str) -> str:
    ties = ", ".join(
        f"{c} DESC NULLS LAST" for c in (
            "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"))
    return f"""
SELECT * EXCLUDE (r) REPLACE ({_time('l_shipdate')} AS l_shipdate) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {first}, {ties}) AS r FROM lineitem
) WHERE r = 1"""


def _duplicates(name: str, table: str, key: str) -> str:
    return f"""
SELECT '{name}' AS table_name, n AS total_rows, u AS distinct_keys,
       round(1 - CAST(u AS DOUBLE) / n, 9) AS duplicate_ratio, CASE WHEN 1 - CAST(u AS DOUBLE) / n > 0.5 THEN 1 ELSE 0 END AS alert
FROM (SELECT (SELECT count(*) FROM {table}) AS n, (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS u)"""


_EVENTS = """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
       CASE event_type WHEN 'purchase' THEN 'purchases' WHEN 'signup' THEN 'customers' WHEN 'click' THEN 'products'
            WHEN 'view' THEN 'stores' ELSE event_type END AS source,
       CASE WHEN event_id % 7 = 0 THEN substr(props, 1, 4) ELSE props END AS raw_json, event_id, ts AS t
FROM events"""


def _rejects(entity: str, docs: str, *rules: tuple[str, str]) -> str:
    whens = " ".join(f"WHEN NOT coalesce({ok}, FALSE) THEN '{name}'" for name, ok in rules)
    return f"""
SELECT '{entity}' AS entity, reason, count(*) AS rows FROM (SELECT CASE {whens} END AS reason FROM ({docs}))
WHERE reason IS NOT NULL GROUP BY reason"""


def _stream_mart(customer: str = "customer_id", store: str = "store_id") -> str:
    purchases = f"""
SELECT purchase_id, {customer} AS customer_id, {store} AS store_id, total_amount, lower(payment_method) AS payment_method,
       is_delivery, purchase_datetime FROM ({_last(_PURCHASE_DOCS, _GOOD_PURCHASES)})"""
    customers = f"""
SELECT customer_id, registration_date, is_loyalty_member FROM ({_last(_CUSTOMER_DOCS, _GOOD_CUSTOMERS)})"""
    return _mart(_totals(purchases, 'count(purchase_id)', 'total_amount'), customers, _ELAPSED)


_MOVED_CUSTOMER = "CASE WHEN k % 30 = 0 THEN 'cus-' || (CAST(substr(customer_id, 5) AS BIGINT) + 1) ELSE customer_id END"
_MOVED_STORE = "CASE WHEN k % 30 = 0 THEN '0-MOVED' ELSE store_id END"


def _panels() -> str:
    return f"""
WITH p AS (SELECT {_MOVED_CUSTOMER} AS customer_id, {_MOVED_STORE} AS store_id, total_amount,
                  strftime(purchase_datetime, '%Y-%m-%d') AS day FROM ({_last(_PURCHASE_DOCS, _GOOD_PURCHASES)})),
money AS (
  SELECT 'total' AS panel, '' AS key, count(*) AS purchases, sum(total_amount) AS revenue FROM p UNION ALL
  SELECT 'store', store_id, count(*), sum(total_amount) FROM p GROUP BY store_id UNION ALL
  SELECT 'day', day, count(*), sum(total_amount) FROM p GROUP BY day)
SELECT panel, key, purchases, round(revenue, 2) AS revenue, CAST(NULL AS BIGINT) AS active_days, CAST(NULL AS VARCHAR) AS last_day FROM money
UNION ALL SELECT 'customer', customer_id, count(*), NULL, count(DISTINCT day), max(day) FROM p GROUP BY customer_id"""


def _month_ends() -> str:
    ends = ", ".join(f"(TIMESTAMP '1995-{m:02d}-{d} 00:00:00')"
                     for m, d in enumerate((31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31), 1))

    def within(days: int) -> str:
        return f" AND purchase_datetime >= d - INTERVAL {days} DAY"

    return f"""
WITH ends AS (SELECT * FROM (VALUES {ends}) e(d)),
p AS (SELECT customer_id, d, {_bit("count(*) > 2", "recurrent_buyer")}, {_bit("avg(total_amount) > 300000", "bulk_buyer")},
        {_bit("avg(total_amount) < 150000", "low_cost_buyer")}, {_bit("max(purchase_datetime) > d", "active_today")},
        {_bit("max(purchase_datetime) < d - INTERVAL 30 DAY", "inactive_30d")}
      FROM ({_PURCHASES}) JOIN ends ON purchase_datetime <= d GROUP BY customer_id, d),
f AS (SELECT customer_id, d, {_flag(f"category = 'milk'{within(30)}", "bought_milk_last_30d")},
        {_flag(f"category = 'fruits'{within(14)}", "bought_fruits_last_14d")},
        {_flag(f"category = 'veggies'{within(14)}", "not_bought_veggies_14d", negate=True)}, {_flag("category = 'bakery'", "buys_bakery")}
      FROM ({_LINES}) JOIN ends ON purchase_datetime <= d GROUP BY customer_id, d)
SELECT p.* EXCLUDE (d), {_time('p.d')} AS as_of, coalesce(bought_milk_last_30d, 0) AS bought_milk_last_30d,
       coalesce(bought_fruits_last_14d, 0) AS bought_fruits_last_14d, coalesce(not_bought_veggies_14d, 1) AS not_bought_veggies_14d,
       coalesce(buys_bakery, 0) AS buys_bakery
FROM p LEFT JOIN f ON p.customer_id = f.customer_id AND p.d = f.d"""


def oracle_sql() -> dict[str, str]:
    named = f"""
SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS region FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
    weighted = f"""
SELECT customer_id, total_amount, product_id, category FROM ({_LINES}) UNION ALL
SELECT o_custkey, o_totalprice, NULL, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
    pieces = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_returnflag, l_extendedprice / l_quantity AS price,
       CASE WHEN l_quantity > 25 THEN 25 ELSE l_quantity END AS quantity FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_returnflag, l_extendedprice / l_quantity, l_quantity - 25
FROM lineitem WHERE l_quantity > 25"""
    ingested = f"""
SELECT purchase_id, customer_id, store_id, total_amount, lower(payment_method) AS payment_method, is_delivery,
       {_time('purchase_datetime')} AS purchase_datetime, {_DELIVERY}
FROM ({_last(_PURCHASE_DOCS, _GOOD_PURCHASES)})"""
    return {
        "customer_agg": f"SELECT {_TOTAL_COLUMNS} FROM ({_TOLERANT}) p",
        "customer_mart": _mart(_TOLERANT, _FIRST_ROW, _ELAPSED),
        "customer_mart_sql": _mart(_totals(_GAPPY, "count(*)", "total_amount"), _REPEATED, _CALENDAR),
        "customer_mart_full_refresh": _mart(_totals(_PURCHASES, "count(*)", "total_amount"), _CUSTOMERS, _ELAPSED),
        "conditional_counts": f"""
SELECT store_id, count(*) AS rows, CAST(count(*) FILTER (WHERE payment_method = 'cash') AS BIGINT) AS cash_count,
       CAST(count(*) FILTER (WHERE payment_method = 'card') AS BIGINT) AS card_count
FROM ({_PURCHASES}) GROUP BY store_id""",
        "conditional_distinct": f"""
SELECT customer_id, count(DISTINCT CASE WHEN category = 'milk' THEN product_id END) AS milk_products,
       count(DISTINCT CASE WHEN category = 'fruits' THEN product_id END) AS fruit_products,
       count(DISTINCT CASE WHEN category = 'bakery' THEN product_id END) AS bakery_products
FROM ({_LINES}) GROUP BY customer_id""",
        "distinct_stores": f"SELECT customer_id, count(DISTINCT store_id) AS distinct_stores FROM ({_LINES}) GROUP BY customer_id",
        "features_as_coded": _features("min", False),
        "features_from_documents": f"SELECT * REPLACE ('cus-' || customer_id AS customer_id) FROM ({_features('min', False)})",
        "features_windowed": _features("max", True),
        "features_item_weighted": f"""
SELECT customer_id, {_bit("avg(total_amount) > 300000", "bulk_buyer")}, {_bit("avg(total_amount) < 150000", "low_cost_buyer")},
       {_flag("category = 'bakery'", "buys_bakery")}
FROM ({weighted}) GROUP BY customer_id""",
        "feature_vegetarian": f"""
SELECT customer_id, {_flag("category = 'meat'", "vegetarian_profile", negate=True)} FROM ({_LINES}) GROUP BY customer_id""",
        "feature_profile": f"""
SELECT p.*, {_bit(_ELAPSED, "new_customer")}, coalesce(is_loyalty_member, 0) AS is_loyalty_member
FROM ({_purchase_features('min')}) p LEFT JOIN ({_CUSTOMERS}) c ON p.customer_id = c.customer_id""",
        "items_enriched": f"""
SELECT CASE WHEN l_partkey % 17 = 0 THEN -l_partkey - 1 ELSE l_partkey END AS product_id, l_orderkey AS purchase_id, l_suppkey AS store_id, l_quantity AS quantity,
       l_extendedprice AS total_price, CASE WHEN p_partkey IS NOT NULL THEN {_CATEGORY} END AS category,
       p_retailprice AS price
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_partkey % 17 <> 0""",
        "purchase_items_explode": f"""
SELECT 'ord-' || l_orderkey || '-' || l_linenumber AS purchase_id, 'store-' || l_suppkey AS store_id,
       'prd-' || l_partkey AS product_id, 'Part ' || l_partkey AS product_name, l_returnflag AS item_category,
       CAST(quantity AS BIGINT) AS quantity, 'PCS' AS unit, price AS price_per_unit, price * quantity AS total_price
FROM ({pieces})""",
        "orphan_purchases": f"""
SELECT purchase_id, 'customer_id' AS missing FROM ({_PURCHASES}) WHERE customer_id % 9 = 0 OR customer_id NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT l_orderkey, 'product_id' FROM lineitem WHERE l_partkey % 17 = 0 OR l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT l_orderkey, 'store_id' FROM lineitem WHERE l_suppkey % 7 = 0 OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
        "basket_reconcile": """
SELECT o_orderkey AS purchase_id, o_totalprice AS total_amount, round(coalesce(s, 0), 2) AS items_total,
       coalesce(n, 0) AS item_count, round(o_totalprice - coalesce(s, 0), 2) AS difference,
       CASE WHEN abs(o_totalprice - coalesce(s, 0)) <= 0.005 THEN 1 ELSE 0 END AS matches
FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s, count(*) AS n FROM lineitem GROUP BY l_orderkey)
     ON o_orderkey = l_orderkey""",
        "revenue_by_store": f"""
SELECT l_suppkey AS store_id, count(*) AS purchases, round(sum(l_extendedprice), 2) AS revenue, any_value(store_name) AS store_name
FROM lineitem LEFT JOIN ({named}) ON l_suppkey = store_id GROUP BY l_suppkey""",
        "revenue_by_region": f"""
SELECT region, count(*) AS purchases, round(sum(l_extendedprice), 2) AS revenue, count(DISTINCT l_suppkey) AS active_stores
FROM lineitem LEFT JOIN ({named}) ON l_suppkey = store_id GROUP BY region""",
        **dict.fromkeys(("top10_products", "top10_from_states"), """
SELECT product_id, round(revenue, 2) AS revenue, units FROM (
  SELECT l_partkey AS product_id, sum(l_extendedprice) AS revenue, sum(l_quantity) AS units FROM lineitem GROUP BY l_partkey
) ORDER BY revenue DESC, product_id LIMIT 10"""),
        "trend_by_day": """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS purchases, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1""",
        "customer_activity": """
SELECT o_custkey AS customer_id, count(*) AS purchases, count(DISTINCT CAST(o_orderdate AS DATE)) AS active_days,
       strftime(max(o_orderdate), '%Y-%m-%d') AS last_day,
       CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-01') AS INTEGER) AS days_since_last
FROM orders GROUP BY o_custkey""",
        "volume_totals": """
SELECT 'purchases' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'stores', count(*) FROM supplier""",
        "duplicate_ratio_alert": " UNION ALL ".join([
            _duplicates("customers", "customer", "c_custkey"), _duplicates("products", "part", "p_partkey"),
            _duplicates("stores", "supplier", "s_suppkey"), _duplicates("purchases", "orders", "o_orderkey"),
            _duplicates("lines", "lineitem", "l_orderkey"),
            _duplicates("items", "lineitem", "l_orderkey, l_linenumber")]),
        "distinct_rows": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
        "dedup_by_key": _lineitem_by_key("l_shipdate ASC NULLS LAST"),
        "dedup_latest": _lineitem_by_key("l_shipdate DESC NULLS LAST"),
        "drop_blank_keys": """
SELECT 'cus-' || c_custkey AS customer_id, c_name FROM customer
WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0""",
        "upsert_by_key": """
WITH base AS (SELECT p_partkey AS product_id, p_name AS name, p_retailprice AS price FROM part),
sent AS (
  SELECT CASE WHEN product_id % 30 = 0 THEN NULL WHEN product_id % 25 = 1 THEN product_id + 10000000000 ELSE product_id END AS product_id,
         name, price + seq AS price, seq
  FROM base, (VALUES (1), (2)) v(seq) WHERE product_id % 10 = 0 OR product_id % 25 = 1)
SELECT product_id, name, price, 0 AS seq FROM base
WHERE product_id NOT IN (SELECT product_id FROM sent WHERE product_id IS NOT NULL)
UNION ALL SELECT * FROM sent WHERE product_id IS NULL OR seq = 2""",
        "peek_limit": f"""
SELECT source AS topic, raw_json AS value, ts AS sent_at FROM ({_EVENTS}) ORDER BY t, raw_json LIMIT 5""",
        "publish_json_roundtrip": f"""
SELECT 'products' AS topic, product_id AS id, name, calories, price, CAST(p_size AS BIGINT) * 2500 AS expiry_days,
       is_organic, manufacturer_inn AS inn FROM ({_PRODUCT_DOCS}) JOIN part ON k = p_partkey""",
        "publish_documents": f"""
SELECT 'prd-' || p_partkey AS id, CAST(CAST(p_size AS BIGINT) * 2500 AS VARCHAR) AS expiry_days,
       CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS is_text, CAST(p_partkey % 5 AS VARCHAR) AS aisle, NULL::VARCHAR AS put_aside
FROM part, {_D} WHERE (d = 0 OR p_partkey % 10 = 0) AND p_partkey % 11 <> 5
UNION ALL SELECT NULL, NULL, NULL, NULL, substr('{{"id":"prd-' || p_partkey || '","name":"' || p_name, 1, 20)
FROM part, {_D} WHERE (d = 0 OR p_partkey % 10 = 0) AND p_partkey % 11 = 5""",
        "mask_texts": f"""
SELECT c_custkey AS id, m AS email_masked, m AS nested_masked, CASE WHEN c_custkey % 4 = 2 THEN '1' END AS kept, 0 AS plain_left
FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN {_hmac("'c' || c_custkey || '@example.com'")}
                             WHEN c_custkey % 4 <> 2 THEN {_hmac("''")} END AS m FROM customer)""",
        "clean_exact": f"""
SELECT DISTINCT purchase_id, customer_id, store_id, total_amount, lower(payment_method) AS payment_method, is_delivery,
       {_time('purchase_datetime')} AS purchase_datetime, {_DELIVERY}, ins_ts
FROM ({_PURCHASE_DOCS}) WHERE {_GOOD_PURCHASES}""",
        "csv_export": f"SELECT {_TOTAL_COLUMNS} FROM ({_TOLERANT}) p",
        "table_fallback": f"""
SELECT * REPLACE ({_time('purchase_datetime')} AS purchase_datetime, {_time('registration_date')} AS registration_date)
FROM (SELECT * FROM ({_PURCHASES}) UNION ALL BY NAME SELECT * FROM ({_CUSTOMERS}))""",
        "mart_defaults": _mart(
            _totals(f"""SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN -customer_id - 1 ELSE customer_id END AS customer_id,
                        CASE WHEN purchase_id % 13 = 0 THEN 0 ELSE total_amount END AS total_amount,
                        '' AS payment_method, 0 AS is_delivery) FROM ({_PURCHASES})""", "count(*)", "total_amount"),
            _CUSTOMERS, _ELAPSED),
        "features_month_ends": _month_ends(),
        "baskets_copartitioned": """
SELECT l_orderkey AS purchase_id, any_value(o_custkey) AS customer_id, count(*) AS lines,
       round(sum(l_extendedprice), 2) AS items_total, max(o_totalprice) AS total_amount
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""",
        "distinct_buyers_sketch": f"""
SELECT store_id, CAST(year(purchase_datetime) AS INTEGER) AS year, count(*) AS purchases,
       count(DISTINCT customer_id) AS buyers, 1 AS within_bound FROM ({_PURCHASES}) GROUP BY 1, 2""",
        "clustered_lookup": f"""
SELECT asked, p.* REPLACE ({_time('purchase_datetime')} AS purchase_datetime) FROM ({_PURCHASES}) p
JOIN (VALUES ('customers'), ('days'), ('purchases')) v(asked) ON CASE asked
  WHEN 'customers' THEN customer_id BETWEEN 200 AND 260
  WHEN 'days' THEN customer_id = 7 AND purchase_datetime BETWEEN TIMESTAMP '1993-01-01' AND TIMESTAMP '1996-12-31'
  ELSE purchase_id IN (1, 77, 500, 1200) END""",
        "best_effort_times": """
SELECT o_orderkey AS purchase_id, CASE WHEN o_orderkey % 11 <> 10 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS at
FROM orders""",
        "raw_landing": f"SELECT ts, source, raw_json FROM ({_EVENTS})",
        "quarantine_split": f"""
SELECT ts, source, raw_json, CASE WHEN source = 'error' THEN 'unknown topic' ELSE 'unreadable document' END AS problem
FROM ({_EVENTS}) WHERE source = 'error' OR event_id % 7 = 0""",
        "parse_customers": f"""
SELECT customer_id, first_name, last_name, {_hmac("'c' || k || '@example.com'")} AS email_masked,
       {_hmac(_normal('k'))} AS phone_masked, gender, {_CUSTOMER_TAIL} FROM ({_CUSTOMER_DOCS})""",
        "parse_products": f"SELECT * EXCLUDE (k, d) FROM ({_PRODUCT_DOCS})",
        "parse_stores": f"""
SELECT * EXCLUDE (k, d) REPLACE (strftime(last_inventory_date, '%Y-%m-%d') AS last_inventory_date) FROM ({_STORE_DOCS})""",
        "parse_purchases": f"""
SELECT * EXCLUDE (k, d) REPLACE ({_time('purchase_datetime')} AS purchase_datetime) FROM ({_PURCHASE_DOCS})""",
        "clean_customers": f"""
SELECT customer_id, lower(first_name) AS first_name, lower(last_name) AS last_name,
       {_hmac("'c' || k || '@example.com'")} AS email_masked, {_hmac(_normal('k'))} AS phone_masked, lower(gender) AS gender,
       {_CUSTOMER_TAIL} FROM ({_last(_CUSTOMER_DOCS, _GOOD_CUSTOMERS)})""",
        "clean_products": f"""
SELECT product_id, lower(name) AS name, lower(category) AS category, lower(description) AS description, calories,
       protein, fat, carbohydrates, price, lower(unit) AS unit, lower(origin_country) AS origin_country, expiry_days,
       is_organic, barcode, lower(manufacturer_name) AS manufacturer_name,
       lower(manufacturer_country) AS manufacturer_country, manufacturer_website, manufacturer_inn, ins_ts
FROM ({_last(_PRODUCT_DOCS, 'price >= 0')})""",
        "clean_stores": f"""
SELECT store_id, lower(store_name) AS store_name, lower(store_network) AS store_network, lower(city) AS city,
       lower(street) AS street, house, postal_code, lower(manager_name) AS manager_name, manager_phone, manager_email,
       accepts_online_orders, delivery_available, warehouse_connected,
       strftime(last_inventory_date, '%Y-%m-%d 00:00:00') AS last_inventory_date, ins_ts
FROM ({_last(_STORE_DOCS, 'TRUE')})""",
        "clean_purchases": f"""
SELECT purchase_id, customer_id, store_id, total_amount, lower(payment_method) AS payment_method, is_delivery,
       {_time('purchase_datetime')} AS purchase_datetime, {_DELIVERY}, ins_ts
FROM ({_last(_PURCHASE_DOCS, _GOOD_PURCHASES)})""",
        "rejects_by_reason": " UNION ALL ".join([
            _rejects("customers", _CUSTOMER_DOCS, ("blank_key", "k % 97 <> 0"),
                     ("birth_date_missing_or_future", "birth_date <= DATE '1996-01-01'"),
                     ("registration_date_missing_or_future", f"registration_date <= {_AS_OF}")),
            _rejects("products", _PRODUCT_DOCS, ("price_missing_or_negative", "price >= 0")),
            _rejects("purchases", _PURCHASE_DOCS,
                     ("purchase_datetime_missing_or_future", f"purchase_datetime <= {_AS_OF}"),
                     ("total_amount_missing_or_negative", "total_amount >= 0"))]),
        "normalize_phone": f"""
SELECT c_custkey AS customer_id, {_phone('c_custkey')} AS phone, {_normal('c_custkey')} AS normalized FROM customer""",
        "mask_hmac": f"SELECT doc_id, {_hmac('lower(trim(text))')} AS text_masked FROM documents",
        "mask_customers": f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS loyalty_card_number,
       {_hmac("'c' || c_custkey || '@example.com'")} AS email_masked, {_hmac(_normal('c_custkey'))} AS phone_masked
FROM customer, {_D} WHERE d = 0 OR c_custkey % 10 = 0""",
        "mask_nested": f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS card, c_name AS first_name,
       {_hmac("'c' || c_custkey || '@example.com'")} AS email_masked, {_hmac(_normal('c_custkey'))} AS phone_masked
FROM customer, {_D} WHERE d = 0 OR c_custkey % 10 = 0""",
        "stream_ingest_clean": ingested,
        "stream_compacted": ingested,
        "stream_mart_refresh": _stream_mart(),
        "stream_mart_states": _stream_mart(_MOVED_CUSTOMER, _MOVED_STORE),
        "stream_panels": _panels(),
        "stream_redelivery_dedup": "SELECT event_id, user_id FROM events",
        "landed_redelivery": "SELECT event_id, user_id FROM events",
        "schema_drift": f"""
SELECT * FROM (
SELECT 'customers' AS entity, 'nickname' AS path, 'undeclared' AS problem, 'STRING' AS kind, count(*) AS documents
FROM ({_CUSTOMER_DOCS}) WHERE k % 4 = 0 UNION ALL
SELECT 'products', 'price', 'retyped', 'STRING', count(*) FROM ({_PRODUCT_DOCS}) WHERE k % 5 = 0 UNION ALL
SELECT 'stores', 'manager.age', 'undeclared', 'BIGINT', count(*) FROM ({_STORE_DOCS}) WHERE k % 2 = 0 UNION ALL
SELECT 'purchases', 'store', 'retyped', 'STRING', count(*) FROM ({_PURCHASE_DOCS}) WHERE k % 10 = 0) WHERE documents > 0""",
        "stream_trend_by_day": """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS purchases, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1""",
    }
