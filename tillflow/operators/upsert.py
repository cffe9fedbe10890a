"""Replace rows by key, insert the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.dedup import keep_latest


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str] = (), order_by: Sequence[str] = ()) -> DataFrame:
    """``base`` after ``updates``: the last update of a key wins; rows without a key are inserted.

    ``base`` is not sorted or regrouped: it only loses the replaced keys, by an anti-join with the
    updated keys, which stay small when a batch is small. Without ``keys`` everything is inserted.
    """
    if not keys:
        return base.unionByName(updates)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    latest = keep_latest(updates.where(has_key), keys, order_by)
    kept = base.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest).unionByName(updates.where(~has_key))
