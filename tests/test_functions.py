import hashlib
import hmac
import re
from datetime import date, datetime

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillflow.functions import lenient
from tillflow.functions.clock import as_of_like
from tillflow.functions.masking import mask_phone, mask_value, normalize_phone


def column(spark, values, type_="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")


def apply(spark, function, values):
    out = column(spark, values).select("i", function(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.i)]


def python_hmac(value, key):
    return hmac.new(key.encode(), (value or "").strip().lower().encode(), hashlib.sha256).hexdigest()


@pytest.mark.parametrize("key", ["k", "x" * 64, "long key " * 20, "ключ"])
def test_mask_value_equals_hmac(spark, key):
    values = ["A@B.com", "  spaced \t", "", None, "Кириллица", " thin\xa0", "a\nb"]
    assert apply(spark, lambda c: mask_value(c, key), values) == [python_hmac(v, key) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x24F), max_size=40), min_size=20, max_size=20))
def test_mask_value_property(spark, values):
    assert apply(spark, lambda c: mask_value(c, "key"), values) == [python_hmac(v, "key") for v in values]


def test_normalize_phone(spark):
    cases = {
        "8 (757) 898-0244": "+77578980244", "+7 477 016 05 93": "+74770160593", "9155475195": "+79155475195",
        "": "", None: "", "abc": "", "12345": "+12345", "89": "+89", "+1 234 567 89 01": "+12345678901",
        "٣٤٥": "+٣٤٥",
    }
    assert apply(spark, normalize_phone, list(cases)) == list(cases.values())


def test_masked_phones_meet_whatever_the_spelling(spark):
    masked = apply(spark, lambda c: mask_phone(c, "key"), ["8 (915) 547-51-95", "+7 915 5475195", "9155475195"])
    assert len(set(masked)) == 1 and re.fullmatch(r"[0-9a-f]{64}", masked[0])


def test_blank_to_null(spark):
    assert apply(spark, lenient.blank_to_null, ["", "  ", "　\t\n", None, " a b "]) == [None, None, None, None, "a b"]


def test_numbers(spark):
    values = ["12", "12.5", "70000", "-1", "NaN", "", "x", None]
    assert apply(spark, lenient.to_float, values) == [12.0, 12.5, 70000.0, -1.0, None, None, None, None]
    assert apply(spark, lenient.to_uint16, values) == [12, None, None, None, None, None, None, None]


def test_flag(spark):
    assert apply(spark, lenient.to_flag, ["true", "TRUE", "false", "1", "", None]) == [1, 1, 0, 0, 0, 0]


def test_day(spark):
    values = ["2024-02-29", "2023-02-29", "2024-1-2", "2024-01-02T00:00:00", "", None]
    assert apply(spark, lenient.to_day, values) == [date(2024, 2, 29), None, None, None, None, None]


def test_instant(spark):
    t = datetime(2024, 1, 2, 3, 4, 5)
    day = datetime(2024, 1, 2)
    cases = {
        "2024-01-02T03:04:05.678901": t, "2024-01-02 03:04:05": t, "20240102030405": t, "02.01.2024 03:04:05": t,
        "02/01/2024 03:04:05": t, "2024/01/02 03:04:05": t, "1704164645": t, "2024-01-02T03:04:05Z": t,
        "2024-01-02T06:04:05+03:00": t, "2024-01-02": day, "20240102": day, "02.01.2024": day, "2024/01/02": day,
        "12:30": None, "2024-13-45": None, "bad": None, "": None, None: None,
    }
    assert apply(spark, lenient.to_instant, list(cases)) == list(cases.values())


def test_strict_instant_fails_the_query(spark):
    assert apply(spark, lenient.to_instant_strict, ["2024-01-02", None]) == [datetime(2024, 1, 2), None]
    with pytest.raises(PySparkException, match="cannot read date and time: nonsense"):
        apply(spark, lenient.to_instant_strict, ["nonsense"])


def test_as_of_takes_the_type_of_the_column(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01' AS n, timestamp'2024-01-01' AS t, date'2024-01-01' AS d, 'x' AS s")
    for c, kind in {"n": "timestamp_ntz", "t": "timestamp", "d": "date", "s": "timestamp"}.items():
        for moment in ("2024-01-01 00:00:00", datetime(2024, 1, 1), None):
            assert df.select(as_of_like(df, c, moment).alias("a")).schema["a"].dataType.simpleString() == kind


def test_rows_helper_orders_nulls(spark):
    assert rows(column(spark, ["b", None, "a"]), "v") == [(None,), ("a",), ("b",)]
