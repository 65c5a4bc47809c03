"""Layouts by evidence: parts above 12 decide, then what more values fit, then month first."""

import datetime as dt

import pytest

from strata.functions.dates import cast_dates, date_evidence


@pytest.mark.parametrize("values, layout", [
    (["3/4/2022", "5/6/2022"], "month first"),
    (["3/4/2022", "13/6/2022"], "day first"),
    (["3/4/2022", "6/13/2022"], "month first"),
    (["13/4/2022", "4/13/2022", "25.12.2022", "1-2-2022"], "day first"),  # both speak: more values fit day first
    (["2022-03-04", None, "", "junk"], "month first"),
    ([], "month first")])
def test_layout_follows_evidence(spark, values, layout):
    df = spark.createDataFrame([(v, v) for v in values], "a string, b string")
    got = date_evidence(df, ["a", "b"]).collect()
    assert [r["layout"] for r in got] == [layout] * 2 and [r["column_name"] for r in got] == ["a", "b"]


def test_columns_are_read_in_their_own_layout(spark):
    df = spark.createDataFrame([(1, "3/4/2022", " 13.4.2022 "), (2, "4/25/2022", "3-4-2022"), (3, "2022-3-4", "2022/03/04"), (4, "30/2/2022", "x"), (5, None, "30.2.2022")],
                               "i int, us string, eu string")
    got = {r["i"]: (r["us"], r["eu"]) for r in cast_dates(df, ["us", "eu"]).collect()}
    d = dt.date
    assert got == {1: (d(2022, 3, 4), d(2022, 4, 13)), 2: (d(2022, 4, 25), d(2022, 4, 3)), 3: (d(2022, 3, 4),) * 2, 4: (None, None), 5: (None, None)}
