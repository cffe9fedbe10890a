"""The end-to-end jobs: publish, ingest, mart, features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators import features as feat
from tillflow.operators.items import enrich_items, explode_items
from tillflow.operators.mart import customer_mart
from tillflow.operators.masking import DEFAULT_STRUCTS, mask_text
from tillflow.schemas import ENTITIES
from tillflow.sinks.csv import export_csv
from tillflow.sinks.tables import refresh_folder, stamped
from tillflow.sinks.topics import texts_to_messages
from tillflow.sources.documents import read_texts, readable, unreadable
from tillflow.sources.tables import first_existing


def masked_messages(spark: SparkSession, documents_root: str, entity: str, key: str | bytes, *,
                    mask_managers: bool = False, multi_line: bool = True) -> DataFrame:
    """Readable documents of one entity, masked and otherwise unchanged, as messages for its topic."""
    structs = (*DEFAULT_STRUCTS, "manager") if mask_managers else DEFAULT_STRUCTS
    texts = readable(read_texts(spark, f"{documents_root}/{entity}", multi_line=multi_line))
    return texts_to_messages(texts.select(mask_text(F.col("body"), key, structs=structs).alias("body")), entity)


def broken_documents(spark: SparkSession, documents_root: str, entity: str, *, multi_line: bool = True) -> DataFrame:
    """Documents of one entity that cannot be published, with their text."""
    return unreadable(read_texts(spark, f"{documents_root}/{entity}", multi_line=multi_line), entity)


def publish_all(spark: SparkSession, documents_root: str, key: str | bytes, send, put_aside, *, multi_line: bool = True,
                **options: bool) -> None:
    """Publish every entity; ``send(messages)`` is a topic sink, ``put_aside(rows)`` takes unreadable documents."""
    for entity in ENTITIES:
        put_aside(broken_documents(spark, documents_root, entity, multi_line=multi_line))
        send(masked_messages(spark, documents_root, entity, key, multi_line=multi_line, **options))


def warehouse(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The four tables, clean where there is a clean one, typed otherwise."""
    return {e: first_existing(spark, f"{database}.clean_{e}", f"{database}.{e}") for e in ENTITIES}


def mart_job(purchases: DataFrame, customers: DataFrame, mart_root: str, export_root: str, run_at: datetime,
             *, name: str = "mart_customer_agg") -> str:
    """Compute the mart once, store it, and export the stored version as dated CSV."""
    spark = purchases.sparkSession
    mart = customer_mart(purchases, customers, as_of=run_at)
    stored = refresh_folder(stamped(mart), mart_root, f"{run_at:%Y%m%dT%H%M%S}", sort_by=["customer_id"])
    export_csv(spark.read.parquet(stored).drop("ins_ts"), export_root, name, run_at, required=False)
    return stored


def feature_table(purchases: DataFrame, products: DataFrame, *, as_of: datetime | str | None = None,
                  windowed: bool = False, item_weighted: bool = False, vegetarian: bool = False,
                  **thresholds) -> DataFrame:
    """Features of clean purchases, whose items are still text.

    Purchases are read and their items decoded once: the header's columns come from each purchase's first line. Only the
    item-weighted variant, an average over lines beside one over purchases, looks at the purchases again.
    """
    items = explode_items(purchases, keep_empty=True, first="_first")
    labelled = products.select("product_id", feat.category_group(F.col("category")).alias("category"))
    lines = enrich_items(items, labelled)
    flags = feat.CATEGORY_FLAGS + ((feat.VEGETARIAN,) if vegetarian else ())
    if not item_weighted:
        return feat.features_of_lines(lines, first="_first", as_of=as_of, flags=flags, windowed=windowed, **thresholds)
    return feat.customer_features(
        purchases, lines, as_of=as_of, flags=flags, windowed=windowed, item_weighted=item_weighted, **thresholds
    )


def feature_job(purchases: DataFrame, products: DataFrame, export_root: str, run_at: datetime, *,
                name: str = "analytic_result", **options) -> str | None:
    return export_csv(feature_table(purchases, products, as_of=run_at, **options), export_root, name, run_at)
