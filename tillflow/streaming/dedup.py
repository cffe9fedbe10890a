"""Redelivered messages inside a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def drop_redelivered(stream: DataFrame, keys: Sequence[str], time_column: str, delay: str = "1 day", *,
                     salts: int | None = None) -> DataFrame:
    """Keep the first delivery of each key; state is dropped once the watermark passes ``delay``.

    A first pass removes repeats per (key, salt), the salt being the input partition, so a key sent again and again
    is spread over ``salts`` reducers and the second pass sees at most ``salts`` rows of it. By default there are as
    many salts as shuffle partitions; the number must stay the same for the life of a checkpoint. Repeats later than ``delay`` are left to the batch
    ``keep_latest``, which has no horizon.
    """
    salts = salts or int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = stream.withWatermark(time_column, delay)
    if salts > 1:
        out = (
            out.withColumn(_SALT, F.spark_partition_id() % salts)
            .dropDuplicatesWithinWatermark([*keys, _SALT])
            .drop(_SALT)
        )
    return out.dropDuplicatesWithinWatermark(list(keys))
