"""Every registered query against its SQL oracle, on the smallest tables."""

import os

import check
import pytest

import __spark_entry__ as contract
from tillflow.plans.oracles import oracle_sql
from tillflow.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    count, difference = check.compare(spark, con, name, SF_DIR)
    assert not difference
    assert count > 0


# The same without broadcasts, as with larger lookups.
@pytest.mark.parametrize("name", ["customer_mart_sql", "items_enriched", "orphan_purchases", "features_windowed",
                                  "revenue_by_region", "upsert_by_key", "features_item_weighted"])
def test_shuffled_joins_equal_the_oracle_too(spark, con, no_broadcast, name):
    assert check.compare(spark, con, name, SF_DIR)[1] == ""


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns[0] == "customer_id" and out.count() > 0
