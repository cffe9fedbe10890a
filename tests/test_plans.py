"""What the physical plans must look like."""

import os

import pytest

import __spark_entry__ as contract
from tillflow.operators import clean as cleaning
from tillflow.operators.parse import parse
from tillflow.plans import star
from tillflow.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_filter_and_columns_reach_the_scan(spark):
    purchases = star.purchases(spark, SF_DIR)
    out = cleaning.clean(purchases.drop("purchase_id").withColumnRenamed("store_id", "purchase_id"), "purchases",
                         as_of=star.AS_OF, duplicates="keep").select("total_amount")
    text = plan(out)
    assert "LessThanOrEqual(o_orderdate,1996-01-01T00:00)" in text
    assert "PushedFilters: [IsNotNull(o_orderdate), IsNotNull(o_totalprice), " in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in text


def test_documents_are_decoded_once(spark):
    typed = parse(star.raw(star.product_documents(spark, SF_DIR), "products"), "products")
    assert plan(typed).count("from_json") == 1


def test_mart_aggregates_before_it_joins(spark):
    text = plan(contract.queries()["customer_mart"](spark, SF_DIR))
    assert text.count("FileScan") == 2
    join, first_aggregate = text.index("Join"), text.index("HashAggregate")
    assert join < first_aggregate


def test_sql_mart_reads_purchases_once(spark):
    assert plan(contract.queries()["customer_mart_sql"](spark, SF_DIR)).count("orders.parquet") == 1


def test_feature_sides_meet_without_another_shuffle(spark, no_broadcast):
    # header aggregate, line aggregate, and what the lookups of the lines need
    text = plan(contract.queries()["feature_profile"](spark, SF_DIR))
    joins = text.count("SortMergeJoin")
    assert joins == 2 and text.count("Exchange hashpartitioning(customer_id") <= 4


def test_top_products_keeps_ten_per_task(spark):
    assert "TakeOrderedAndProject" in plan(contract.queries()["top10_products"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["feature_vegetarian", "features_windowed", "features_as_coded", "conditional_distinct",
                                  "revenue_by_store", "revenue_by_region", "items_enriched"])
def test_facts_are_scanned_once(spark, no_broadcast, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(contract.queries()[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("lineitem.parquet") == 1 and text.count("orders.parquet") <= 2
