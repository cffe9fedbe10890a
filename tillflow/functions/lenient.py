"""Parsing of text that may be wrong: a value that does not parse becomes NULL, it never fails the job.

ANSI mode is on in Spark 4, so every conversion here goes through a ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

UINT16_MAX = 65535


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` alone removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """Stripped text, or NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def to_float(c: Column) -> Column:
    """Text → double. NaN counts as unparsable, because Spark orders NaN above every number."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_uint16(c: Column) -> Column:
    """Text → integer within 0..65535, else NULL."""
    number = c.try_cast("int")
    return F.when(number.between(0, UINT16_MAX), number)


def to_flag(c: Column) -> Column:
    """1 when the text reads ``true`` in any case, otherwise 0 (also for NULL)."""
    return F.when(F.lower(c) == "true", 1).otherwise(0)


def to_day(c: Column) -> Column:
    """``yyyy-MM-dd`` text → date."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


# Shape of the text → datetime pattern, for everything but ISO text and epoch seconds.
_OTHER_FORMATS = (
    (r"^\d{14}$", "yyyyMMddHHmmss"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
    (r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$", "yyyy/MM/dd HH:mm:ss"),
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
    (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$", "dd/MM/yyyy HH:mm:ss"),
    (r"^\d{2}\.\d{2}\.\d{4}$", "dd.MM.yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2}$", "d MMM yyyy HH:mm:ss"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}:\d{2}$", "dd.MM.yyyy HH:mm:ss"),
)


def to_instant(c: Column) -> Column:
    """Best-effort text → timestamp at second resolution, NULL when nothing fits.

    The shape is tested before each parse: a bare ``12:30`` must not turn into today's date.
    """
    parsed = F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(c)).when(
        c.rlike(r"^\d{9,10}$"), F.timestamp_seconds(c.try_cast("bigint"))
    )
    for shape, pattern in _OTHER_FORMATS:
        parsed = parsed.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(pattern)))
    return F.date_trunc("second", parsed)


def to_instant_strict(c: Column) -> Column:
    """As :func:`to_instant`, but text that does not parse fails the query; NULL stays NULL."""
    parsed = to_instant(c)
    return F.when(
        c.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit("cannot read date and time: "), c)).cast("timestamp"),
    ).otherwise(parsed)
