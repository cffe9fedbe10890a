"""Conditional and distinct counts per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_counts(df: DataFrame, by: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """Rows per group that meet each condition, beside the row count."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )


def conditional_distinct(df: DataFrame, by: Sequence[str], value: str, conditions: dict[str, Column]) -> DataFrame:
    """Distinct non-NULL ``value`` per group among the rows that meet each condition.

    Rows are reduced to (group, value) with one flag per condition, then the flags are counted.
    Several ``count_distinct`` in one aggregate would copy every row once per condition.
    """
    pairs = df.groupBy(*by, value).agg(
        *[F.max(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]
    )
    return pairs.groupBy(*by).agg(
        *[F.count_if(F.col(name) & F.col(value).isNotNull()).alias(name) for name in conditions]
    )


def distinct_count(df: DataFrame, by: Sequence[str], value: str, name: str, *, approximate: bool = False) -> DataFrame:
    """Distinct ``value`` per group: exact, or a sketch (2 % error) where exact costs too much."""
    counter = F.approx_count_distinct(value, 0.02) if approximate else F.count_distinct(value)
    return df.groupBy(*by).agg(counter.alias(name))
