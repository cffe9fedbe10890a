"""Shapes of the four entities at each layer.

Source documents are nested. The raw layer keeps each document as text. The typed layer is
declared once, as a list of columns with the document path they come from; the schema used to
decode the text is derived from those paths, so only what a table needs is decoded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

ENTITIES = ("customers", "products", "stores", "purchases")

RAW = "ts timestamp, source string, raw_json string"

_COORDINATES = "coordinates: struct<latitude: double, longitude: double>"
_PLACE = f"struct<country: string, city: string, street: string, house: string, postal_code: string, {_COORDINATES}>"
_ADDRESS = (
    "struct<country: string, city: string, street: string, house: string, apartment: string, postal_code: string>"
)
_NUTRITION = "struct<calories: double, protein: double, fat: double, carbohydrates: double>"
_MAKER = "struct<name: string, country: string, website: string, inn: string>"

# What an item row needs; decoding skips the nutrition and maker details each item also carries.
ITEM_ROW = (
    "product_id: string, name: string, category: string, quantity: bigint, unit: string, "
    "price_per_unit: double, total_price: double"
)
ITEM = f"struct<{ITEM_ROW}, kbju: {_NUTRITION}, manufacturer: {_MAKER}>"

# Source documents, one JSON object each.
DOCUMENTS = {
    "customers": (
        "customer_id string, first_name string, last_name string, email string, phone string, "
        "birth_date string, gender string, registration_date string, is_loyalty_member boolean, "
        f"loyalty_card_number string, purchase_location {_PLACE}, delivery_address {_ADDRESS}, "
        "preferences struct<preferred_language: string, preferred_payment_method: string, "
        "receive_promotions: boolean>"
    ),
    "products": (
        "id string, name string, `group` string, description string, "
        f"kbju {_NUTRITION}, price double, unit string, origin_country string, expiry_days bigint, "
        f"is_organic boolean, barcode string, manufacturer {_MAKER}"
    ),
    "stores": (
        "store_id string, store_name string, store_network string, store_type_description string, "
        "type string, categories array<string>, manager struct<name: string, phone: string, email: string>, "
        f"location {_PLACE}, opening_hours struct<mon_fri: string, sat: string, sun: string>, "
        "accepts_online_orders boolean, delivery_available boolean, warehouse_connected boolean, "
        "last_inventory_date string"
    ),
    "purchases": (
        "purchase_id string, customer struct<customer_id: string, first_name: string, last_name: string>, "
        f"store struct<store_id: string, store_name: string, store_network: string, location: {_PLACE}>, "
        f"items array<{ITEM}>, total_amount double, payment_method string, is_delivery boolean, "
        f"delivery_address {_ADDRESS}, purchase_datetime string"
    ),
}

# Key of each entity's typed and clean table.
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "stores": "store_id",
    "purchases": "purchase_id",
}


@dataclass(frozen=True)
class Field:
    """One typed column: its name, the dotted document path, and how the text is read."""

    name: str
    path: str
    kind: str = "text"


def _fields(*rows: str) -> tuple[Field, ...]:
    return tuple(Field(*row.split()) for row in rows)


TYPED = {
    "customers": _fields(
        "customer_id customer_id",
        "first_name first_name",
        "last_name last_name",
        "email_masked email_masked",
        "phone_masked phone_masked",
        "gender gender",
        "birth_date birth_date day",
        "registration_date registration_date instant",
        "is_loyalty_member is_loyalty_member flag",
        "loyalty_card_number loyalty_card_number",
        "city purchase_location.city",
        "street purchase_location.street",
        "house purchase_location.house",
        "postal_code purchase_location.postal_code",
    ),
    "products": _fields(
        "product_id id",
        "name name",
        "category group",
        "description description",
        "calories kbju.calories float",
        "protein kbju.protein float",
        "fat kbju.fat float",
        "carbohydrates kbju.carbohydrates float",
        "price price float",
        "unit unit",
        "origin_country origin_country",
        "expiry_days expiry_days uint16",
        "is_organic is_organic flag",
        "barcode barcode",
        "manufacturer_name manufacturer.name",
        "manufacturer_country manufacturer.country",
        "manufacturer_website manufacturer.website",
        "manufacturer_inn manufacturer.inn",
    ),
    "stores": _fields(
        "store_id store_id",
        "store_name store_name",
        "store_network store_network",
        "store_type_description store_type_description",
        "type type",
        "city location.city",
        "street location.street",
        "house location.house",
        "postal_code location.postal_code",
        "manager_name manager.name",
        "manager_phone manager.phone",
        "manager_email manager.email",
        "accepts_online_orders accepts_online_orders flag",
        "delivery_available delivery_available flag",
        "warehouse_connected warehouse_connected flag",
        "last_inventory_date last_inventory_date day",
    ),
    "purchases": _fields(
        "purchase_id purchase_id",
        "customer_id customer.customer_id",
        "store_id store.store_id",
        "total_amount total_amount float",
        "payment_method payment_method",
        "is_delivery is_delivery flag",
        "purchase_datetime purchase_datetime instant",
        "delivery_country delivery_address.country",
        "delivery_city delivery_address.city",
        "delivery_street delivery_address.street",
        "delivery_house delivery_address.house",
        "delivery_apartment delivery_address.apartment",
        "delivery_postal_code delivery_address.postal_code",
        "items_json items",
    ),
}

CORRUPT = "_corrupt"


def typed_fields(entity: str, columns: Sequence[str] | None = None) -> tuple[Field, ...]:
    """The entity's typed columns, or those named in ``columns``."""
    return tuple(f for f in TYPED[entity] if columns is None or f.name in columns)


def decode_schema(entity: str, columns: Sequence[str] | None = None) -> T.StructType:
    """Schema that reads each typed path as text, plus a column for documents that do not parse."""
    tree: dict = {}
    for field in typed_fields(entity, columns):
        node = tree
        *parents, leaf = field.path.split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = None

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(k, build(v) if v else T.StringType()) for k, v in node.items()]
        )

    return build(tree).add(CORRUPT, T.StringType())


MART_COLUMNS = (
    "customer_id",
    "purchase_count",
    "total_spent",
    "avg_basket",
    "first_purchase",
    "last_purchase",
    "distinct_stores",
    "cash_count",
    "card_count",
    "delivery_count",
    "new_customer",
    "is_loyalty_member",
    "registration_date",
)
