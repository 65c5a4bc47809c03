import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from strata.functions import clean_strings, row_changed, try_cast_date, try_cast_int


def test_try_cast_int(spark):
    df = spark.createDataFrame([("abc",), ("12.7",), ("99999999999",), ("",), ("-12.5",), ("42",), (None,)], "s string")
    got = [r[0] for r in df.select(try_cast_int("s")).collect()]
    assert got == [None, 13, None, None, -13, 42, None]


def test_try_cast_date(spark):
    df = spark.createDataFrame([("3/9/2022",), ("13/9/2022",), ("2022-03-09",), ("n/a",), ("03/09/2022",)], "s string")
    got = [r[0] for r in df.select(try_cast_date("s")).collect()]
    d = dt.date(2022, 3, 9)
    assert got == [d, None, d, None, d]


def test_row_changed_is_null_safe(spark):
    # a value moving into the next column beside a null is a change
    df = spark.createDataFrame([("a", None, "a", None), (None, "a", "a", None), (None, None, None, None),
                                ("x", "y", "x", "y")], "a1 string, a2 string, b1 string, b2 string")
    got = [r[0] for r in df.select(row_changed(["a1", "a2"], ["b1", "b2"])).collect()]
    assert got == [False, True, False, False]


def test_clean_strings_null_markers(spark):
    df = spark.createDataFrame([("",), ("NULL",), (" x ",), (None,), ("null",)], "s string")
    assert [r[0] for r in clean_strings(df).collect()] == [None, None, "x", None, "null"]


def test_int_cast_rounds_once(spark):
    df = spark.createDataFrame([("12.4999999",), ("12.5",), ("-12.4999999999",), ("-12.50",), (".49999999",), ("1e2",), ("7",)], "s string")
    assert [r[0] for r in df.select(try_cast_int("s")).collect()] == [12, 13, -12, -13, 0, 100, 7]
