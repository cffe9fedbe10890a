"""``as_of`` in place of "now", so that a run can be repeated with the same result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = datetime | str | None


def as_of_like(df: DataFrame, column: str, as_of: AsOf) -> Column:
    """``as_of`` in the type of ``df[column]``.

    Casting the literal, not the column, keeps ``column <= as_of`` eligible for parquet pushdown.
    """
    dtype = df.schema[column].dataType
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        dtype = T.TimestampType()
    if as_of is None:
        return (F.current_date() if isinstance(dtype, T.DateType) else F.current_timestamp()).cast(dtype)
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp_ntz").cast(dtype)


def start_of_day(moment: Column) -> Column:
    """Midnight of the day of ``moment``, as a date."""
    return F.to_date(moment)


def days_before(moment: Column, days: int) -> Column:
    return moment - F.expr(f"INTERVAL {int(days)} DAYS")
