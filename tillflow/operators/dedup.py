"""Duplicates and blank keys.

A key may be carried by a third of all rows. ``row_number() = 1`` over a window lets Spark cut
each key to one row per task *before* the shuffle (a window group limit), so a hot key sends at
most one row per input task to its reducer. ``distinct`` collapses copies the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.lenient import blank_to_null

_RANK = "_rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows that differ in at least one column."""
    return df.distinct()


def _one_per_key(df: DataFrame, keys: Sequence[str], order: dict[str, Column]) -> DataFrame:
    # Every other sortable column breaks ties, so the survivor does not depend on row order.
    ties = [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema.fields
        if f.name not in keys and f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    window = Window.partitionBy(*keys).orderBy(*order.values(), *ties)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` (NULL is the least)."""
    return _one_per_key(df, keys, {c: F.col(c).desc_nulls_last() for c in order_by})


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order_by`` (NULL comes last)."""
    return _one_per_key(df, keys, {c: F.col(c).asc_nulls_last() for c in order_by})


def drop_blank_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Strip the key columns and leave out rows where one of them is blank or NULL."""
    for key in keys:
        if isinstance(df.schema[key].dataType, T.StringType):
            df = df.withColumn(key, blank_to_null(F.col(key)))
    return df.dropna(subset=list(keys))
