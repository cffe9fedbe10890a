"""Tables clustered by key: what a lookup opens and reads, shown by the scans' own counters."""

import pytest
from conftest import rows
from metrics import files_read, rows_read
from pyspark.sql import functions as F

from tillflow.sinks.clustered import lookup, sparse_index, write_clustered

N = 40_000


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clustered"))
    # Scrambled rows; customer 7 has a third of them, one in fifty has no customer.
    who = F.when(F.col("id") % 50 == 9, None).when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1000)
    made = spark.range(N).select(who.alias("customer_id"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(365)).alias("day"),
                                 (F.xxhash64("id", F.lit(2))).alias("purchase_id"), (F.col("id") * 1.0).alias("amount"))
    write_clustered(made, root, "1", ["customer_id", "day"], bloom=["purchase_id"], files=16, distinct=4000, row_group_bytes=1 << 17)
    return root, made


def test_nothing_is_lost_and_the_index_tells_the_ranges(spark, table):
    root, made = table
    assert rows(spark.read.parquet(f"{root}/version=1")) == rows(made)
    index = sparse_index(spark, root).collect()
    assert sum(r.rows for r in index) == N and len(index) == 16
    # A hot key is spread over several files instead of one; no file holds much more than its share.
    assert max(r.rows for r in index) < 3 * N / 16 and sum(r.low_0 == 7 == r.high_0 for r in index) >= 3
    ordered = sorted(index, key=lambda r: (r.low_0 is not None, r.low_0 or 0, r.high_0 or 0))
    known = [r for r in ordered if r.low_0 is not None]
    assert all(a.high_0 <= b.low_0 for a, b in zip(known, known[1:], strict=False))


@pytest.mark.parametrize("keys, low, high", [
    (["customer_id"], [500], None), (["customer_id"], [-20], [40]), (["customer_id", "day"], [7, 100], [7, 110]),
    (["customer_id"], [10**6], None), (["customer_id", "day"], [3, 5], None)])
def test_lookups_equal_a_filter_and_open_few_files(spark, table, keys, low, high):
    root, made = table
    found, want = lookup(spark, root, keys, low, high), made
    for k, a, b in zip(keys, low, high or low, strict=True):
        want = want.where(F.col(k).between(a, b))
    assert rows(found) == rows(want)
    # Counters are those of a query's first run.
    assert files_read(lookup(spark, root, keys, low, high)) < 16
    if low == [500]:
        assert files_read(lookup(spark, root, keys, low)) == 1 and rows_read(lookup(spark, root, keys, low)) < N / 8
    assert rows(lookup(spark, root, keys, low, high, most_files=0)) == rows(want)


def test_row_groups_without_the_value_are_skipped_by_bloom_filters(spark, table, tmp_path):
    root, made = table
    one = made.orderBy("purchase_id").collect()[N // 2]
    with_filter = spark.read.parquet(f"{root}/version=1").where(F.col("purchase_id") == one.purchase_id)
    plain = str(tmp_path / "plain")
    write_clustered(made, plain, "1", ["customer_id", "day"], files=16, row_group_bytes=1 << 17)
    without = spark.read.parquet(f"{plain}/version=1").where(F.col("purchase_id") == one.purchase_id)
    assert rows(with_filter) == rows(without) and with_filter.count() == 1
    assert rows_read(with_filter) < rows_read(without) / 4


def test_newest_version_counts_and_an_empty_table_is_readable(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    write_clustered(frame.limit(0), root, "1", ["k"])
    assert lookup(spark, root, ["k"], [1]).count() == 0
    write_clustered(frame, root, "2", ["k"])
    assert rows(lookup(spark, root, ["k"], [1], [2])) == [(1, "a"), (2, "b")]
