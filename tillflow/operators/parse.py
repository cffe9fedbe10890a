"""Raw documents (``ts, source, raw_json``) → typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions import lenient

_READERS = {
    "float": lenient.to_float,
    "uint16": lenient.to_uint16,
    "flag": lenient.to_flag,
    "day": lenient.to_day,
    "instant": lenient.to_instant,
}


def decode(raw: DataFrame, entity: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The entity's raw rows with ``doc``: the decoded document, scalars still as text.

    One ``from_json`` per row covers every column. It sits in a one-element ``explode`` because a
    filter on ``doc`` would otherwise be pushed below the projection and decode every row twice.
    The raw table has a folder per topic; a filter on its ``topic`` prunes the scan to one of them.
    ``columns`` limits decoding to the paths of those typed columns.
    """
    doc = F.from_json(
        "raw_json",
        schemas.decode_schema(entity, columns),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    return raw.where(F.col("source") == entity).select("ts", "source", "raw_json", F.explode(F.array(doc)).alias("doc"))


def is_readable() -> Column:
    """True where the document is a JSON object.

    A field of an unexpected shape only loses its own value: such a document is flagged by the
    decoder too, but its top-level keys can be listed. Text after a complete object is ignored.
    """
    flagged = F.col(f"doc.{schemas.CORRUPT}").isNotNull()
    return F.col("doc").isNotNull() & (~flagged | F.json_object_keys("raw_json").isNotNull())


def project(decoded: DataFrame, entity: str, columns: Sequence[str] | None = None, *, strict: bool = False,
            blank_as_empty: bool = False, narrow_float32: bool = False) -> DataFrame:
    """Typed columns of a decoded frame, and the load time.

    ``strict``          a registration date that does not parse fails the query instead of being NULL
    ``blank_as_empty``  missing text becomes ``''`` (as in stores whose strings cannot be NULL)
    ``narrow_float32``  numbers pass through single precision, losing digits
    """
    values = []
    for field in schemas.typed_fields(entity, columns):
        text = F.col(f"doc.{field.path}")
        if field.kind == "text":
            value = F.coalesce(text, F.lit("")) if blank_as_empty else text
        elif field.kind == "instant" and strict and field.name == "registration_date":
            value = lenient.to_instant_strict(text)
        else:
            value = _READERS[field.kind](text)
            if field.kind == "float" and narrow_float32:
                value = value.cast("float").cast("double")
        values.append(value.alias(field.name))
    return decoded.select(*values, F.col("ts").alias("ins_ts"))


def parse(raw: DataFrame, entity: str, columns: Sequence[str] | None = None, **options: bool) -> DataFrame:
    """Typed table of one entity; unreadable documents are left to :func:`quarantine`."""
    return project(decode(raw, entity, columns).where(is_readable()), entity, columns, **options)


def parse_customers(raw: DataFrame, columns: Sequence[str] | None = None, **options: bool) -> DataFrame:
    return parse(raw, "customers", columns, **options)


def parse_products(raw: DataFrame, columns: Sequence[str] | None = None, **options: bool) -> DataFrame:
    return parse(raw, "products", columns, **options)


def parse_stores(raw: DataFrame, columns: Sequence[str] | None = None, **options: bool) -> DataFrame:
    return parse(raw, "stores", columns, **options)


def parse_purchases(raw: DataFrame, columns: Sequence[str] | None = None, **options: bool) -> DataFrame:
    return parse(raw, "purchases", columns, **options)


def quarantine(raw: DataFrame) -> DataFrame:
    """Raw rows no parser takes: unreadable documents, and topics that are not an entity.

    Listing the top-level keys skips over the values, so this costs far less than decoding; it
    fails for exactly the documents :func:`is_readable` turns down.
    """
    known = F.coalesce(F.col("source").isin(*schemas.ENTITIES), F.lit(False))
    problem = F.when(~known, "unknown topic").when(F.json_object_keys("raw_json").isNull(), "unreadable document")
    return raw.select("ts", "source", "raw_json", problem.alias("problem")).where(F.col("problem").isNotNull())
