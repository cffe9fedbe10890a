"""Mergeable summaries: distinct counts by sketch, and best-sellers by bounded lists.

Both are kept per batch or day and merged to any period later, without the rows they were made of.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.operators.dashboards import top_products

# log2 of the registers of a distinct-count sketch: its standard error is about 1.04 / sqrt(2 ** 12) = 1.6 %, 4 KB at most.
PRECISION = 12


def distinct_states(df: DataFrame, by: Sequence[str | Column], value: str, *, precision: int = PRECISION) -> DataFrame:
    """One sketch of the distinct non-NULL ``value`` per group, as ``sketch``, with ``rows``."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(value, precision).alias("sketch"))


def merge_distinct(states: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Sketches of coarser groups; merging loses nothing against one sketch over all rows."""
    return states.groupBy(*by).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(states: DataFrame, name: str) -> DataFrame:
    """The estimate of each sketch in its place."""
    return states.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def relative_error(precision: int = PRECISION, deviations: float = 4) -> float:
    """Bound on the relative error that holds for all but one in 15,000 sketches (four standard errors)."""
    return deviations * 1.04 / (2**precision) ** 0.5


# --- best-sellers ----------------------------------------------------------------------------------


def top_state(items: DataFrame, keep: int, *, key: str = "product_id", amount: str = "total_price") -> DataFrame:
    """(key, amount, cut): the ``keep`` best keys of a batch by summed amount; no other key of it sums up to more than ``cut``.

    Amounts must not be negative; NULL counts as 0. An empty batch leaves an empty state.
    """
    totals = items.groupBy(F.col(key).alias("key")).agg(F.sum(F.coalesce(amount, F.lit(0.0))).alias("amount"))
    # At most keep + 1 rows, in one place: the last one, if there are that many, is the bound and not part of the state.
    best = totals.orderBy(F.desc("amount"), "key").limit(keep + 1).withColumn(
        "place", F.row_number().over(Window.orderBy(F.desc("amount"), "key")))
    cut = F.max(F.when(F.col("place") > keep, F.col("amount"))).over(Window.partitionBy())
    return best.withColumn("cut", F.coalesce(cut, F.lit(0.0))).where(F.col("place") <= keep).drop("place")


@dataclass(frozen=True)
class Candidates:
    """``keys``: every key that may be among the best; ``missed``: an upper bound on what any key outside them sums up to;
    ``complete``: whether that is below the last of the best for certain."""

    keys: DataFrame
    missed: float
    complete: bool


def candidates(states: DataFrame, n: int) -> Candidates:
    """Merge states (with ``batch_id``) and name the candidates for the ``n`` best keys.

    A key's sum lies between what its states hold and that plus the cuts of the batches whose state lacks it. Keys whose
    upper bound is below the n-th largest lower bound are out; a key no state holds has the sum of all cuts as its bound.
    """
    cuts = states.groupBy("batch_id").agg(F.max("cut").alias("cut")).agg(F.coalesce(F.sum("cut"), F.lit(0.0)).alias("all"))
    missed = cuts.first()[0]
    merged = states.groupBy("key").agg(F.sum("amount").alias("low"), (F.sum("amount") + missed - F.sum("cut")).alias("high"))
    nth = merged.orderBy(F.desc("low")).limit(n).agg(F.count("*").alias("n"), F.min("low").alias("low")).first()
    bar = nth.low if nth.n == n else 0.0
    return Candidates(merged.where(F.col("high") >= bar).select("key"), missed, missed < bar or missed == 0)


def best_sellers(items: DataFrame, states: DataFrame, n: int = 10, *, key: str = "product_id") -> DataFrame:
    """Exact best sellers: only the candidates' lines are summed up; all lines, should the states not suffice."""
    found = candidates(states, n)
    wanted = items.join(found.keys.withColumnRenamed("key", key), key, "left_semi") if found.complete else items
    return top_products(wanted, n)
