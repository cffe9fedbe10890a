"""Joins of tables in which one key carries a third of the rows, for the cases adaptive execution cannot split.

Operators use plain joins: Spark broadcasts a side it has measured to be small and splits skewed partitions of a
sort-merge join. Two cases are left, both on request and with a list of hot keys made once: a side that Spark may not
split (the right one of a left join), and a join above an aggregate.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import shared_dir

_HOT, _SALT, _COUNT, _MATCHED = "_hot", "_salt", "_n", "_matched"

HOT_SHARE = 1 / 1000  # a key is hot above this share of the rows, so there are at most 1000
SALTS = 256


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys held by more than ``share`` of the rows: fewer than 1/``share`` of them by definition.

    Counted exactly, in one pass over the key columns of ``df``, which should be a base table and not a joined
    frame. The counts are stored in the shared folder, so that list and total agree and nothing is counted again.
    """
    path = f"{shared_dir(df.sparkSession)}/hot-{uuid.uuid4().hex}"
    df.groupBy(*on).agg(F.count(F.lit(1)).alias(_COUNT)).write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    total = counts.agg(F.sum(_COUNT)).first()[0] or 0
    return counts.where(F.col(_COUNT) > share * total).select(*on)


def _with_salt(big: DataFrame, hot: DataFrame, on: Sequence[str], salts: int) -> DataFrame:
    """Spread the rows of hot keys over ``salts`` values; all other rows get 0.

    The salt is a hash of the row and of its input partition: it spreads identical copies, and it
    is the same when a lost task runs again. NULL keys match nothing and are spread as well, as
    they would otherwise share a reducer.
    """
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns], F.spark_partition_id()), F.lit(salts))
    is_null = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in on])
    salt = F.when(F.col(_HOT).isNotNull() | is_null, spread).otherwise(F.lit(0)).cast("int")
    return big.join(hot, list(on), "left").withColumn(_SALT, salt)


def _for_every_salt(small: DataFrame, hot: DataFrame, on: Sequence[str], salts: int) -> DataFrame:
    """Repeat the rows of hot keys once per salt."""
    every = F.when(F.col(_HOT).isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return small.join(hot, list(on), "left").withColumn(_SALT, F.explode(every))


def _marked(hot: DataFrame) -> DataFrame:
    # The hint is safe: hot_keys gives fewer than 1/share rows whatever the size of its table.
    return F.broadcast(hot.withColumn(_HOT, F.lit(True)))


def salted_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", *, hot: DataFrame,
                salts: int = SALTS) -> DataFrame:
    """Equi-join whose ``facts`` rows of a hot key go to ``salts`` reducers instead of one.

    ``hot`` is the list of :func:`hot_keys`. ``how``: left, inner, left_semi or left_anti. Any lookup row of a key
    is found whatever the salt, so the result does not depend on it.
    """
    marked = _marked(hot)
    left = _with_salt(facts, marked, on, salts).drop(_HOT)
    right = _for_every_salt(lookup, marked, on, salts).drop(_HOT)
    return left.join(right, [*on, _SALT], how).drop(_SALT)


def fan_out_left_join(unique: DataFrame, repeated: DataFrame, on: Sequence[str], *, hot: DataFrame,
                      salts: int = SALTS) -> DataFrame:
    """``unique LEFT JOIN repeated`` where the *right* side holds hot keys, listed in ``hot``.

    Spark cannot split the right side of a left join, so here its hot keys are salted and the left
    rows of those keys repeated. A hot key has matches by definition, so where one of the repeated
    left rows meets none, that row is spurious and is removed.
    """
    marked = _marked(hot)
    left = _for_every_salt(unique, marked, on, salts)
    right = _with_salt(repeated, marked, on, salts).drop(_HOT).withColumn(_MATCHED, F.lit(True))
    joined = left.join(right, [*on, _SALT], "left")
    return joined.where(F.col(_HOT).isNull() | F.col(_MATCHED).isNotNull()).drop(_HOT, _SALT, _MATCHED)
