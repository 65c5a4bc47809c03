import pytest
from pyspark.sql import functions as F

from conftest import rows, srt
from strata.functions import row_changed
from strata.operators.merge import S, T, changes, delete_where, merge, merge_counts, update_where
from strata.operators.quality import AmbiguousMergeError, duplicate_keys, orphans

TGT = "k bigint, v string, n int"


def test_upsert_update_all_and_insert(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], TGT)
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k bigint, v string")
    m = merge(t, s, "k")
    assert rows(m) == srt([(1, "a", 0, None), (2, "B", 0, "UPDATE"), (3, "C", None, "INSERT")])
    assert rows(merge_counts(m)) == srt([(1, 1, 2)])


def test_null_key_never_matches(spark):
    t = spark.createDataFrame([(None, "old", 0)], TGT)
    s = spark.createDataFrame([(None, "new")], "k bigint, v string")
    m = merge(t, s, "k")
    assert rows(m, "k", "v", "_op") == srt([(None, "new", "INSERT"), (None, "old", None)])


def test_ambiguous_source_raises_before_write(spark):
    t = spark.createDataFrame([(1, "a", 0)], TGT)
    s = spark.createDataFrame([(1, "x"), (1, "y"), (5, "p"), (5, "q")], "k bigint, v string")
    with pytest.raises(AmbiguousMergeError):
        merge(t, s, "k")
    # two unmatched rows for one key are fine: both insert
    ok = merge(t, s.filter("k = 5"), "k")
    assert len(changes(ok).collect()) == 2


def test_insert_only_and_conditional_update(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], TGT)
    s = spark.createDataFrame([(1, "a"), (2, "z"), (3, "c")], "k bigint, v string")
    ins = merge(t, s, "k", update=None)
    assert rows(changes(ins), "k", "_op") == srt([(3, "INSERT")])
    cond = merge(t, s, "k", update={"v": S("v"), "n": T("n") + 1}, update_if=T("v") != S("v"), insert=None)
    assert rows(cond) == srt([(1, "a", 0, None), (2, "z", 1, "UPDATE")])


def test_merge_twice_equals_once_when_skipping_unchanged(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], TGT)
    s = spark.createDataFrame([(2, "B", 0), (3, "C", 0)], TGT)
    cond = row_changed([T("v"), T("n")], [S("v"), S("n")])
    once = merge(t, s, "k", update_if=cond).drop("_op")
    twice = merge(once, s, "k", update_if=cond)
    assert changes(twice).count() == 0
    assert rows(twice.drop("_op")) == rows(once)


def test_update_delete_null_predicate(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, None, 0)], TGT)
    assert rows(delete_where(t, F.col("v") == "a")) == [(2, None, 0)]   # null predicate keeps the row
    u = update_where(t, {"n": F.lit(9)}, F.col("v") == "a")
    assert rows(u, "k", "n") == srt([(1, 9), (2, 0)])


def test_pk_and_fk_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    assert rows(duplicate_keys(df, "k")) == srt([(1, 2), (None, 1)])
    dim = spark.createDataFrame([(1,), (2,)], "id bigint")
    fact = spark.createDataFrame([(1,), (3,), (None,)], "fk bigint")
    assert rows(orphans(fact, dim, "fk", "id")) == srt([(3,)])


def test_target_row_with_several_matches_stays_one_row(spark):
    t = spark.createDataFrame([(1, "a", 10), (1, "a", 10), (2, "b", 5)], TGT)
    s = spark.createDataFrame([(1, "x", 10), (1, "y", 10), (3, "z", 1)], TGT)
    none = merge(t, s, "k", update_if=T("n") != S("n"))
    assert rows(none) == srt([(1, "a", 10, None), (1, "a", 10, None), (2, "b", 5, None), (3, "z", 1, "INSERT")])
    assert rows(merge(t, s, "k", update=None)) == rows(none)
    one = merge(t, spark.createDataFrame([(1, "x", 10), (1, "y", 11)], TGT), "k", update_if=T("n") != S("n"))
    assert rows(one) == srt([(1, "y", 11, "UPDATE"), (1, "y", 11, "UPDATE"), (2, "b", 5, None)])
    with pytest.raises(Exception, match="not unique"):
        merge(t, spark.createDataFrame([(1, "x", 12), (1, "y", 11)], TGT), "k", update_if=T("n") != S("n")).collect()
