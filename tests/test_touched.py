"""MERGE of touched rows: equal to the full merge's changes, pruned by bucket, with a check that can't be pruned."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.merge import S, T, changes, merge
from strata.operators.touched import BUCKET, Buckets, matched_rows, merge_touched
from test_plans import plan

TGT = "k bigint, d string, v int, n int"


def target_rows():
    return [(i, f"d{i % 3}", i * 7 % 11, i % 4) for i in range(60)] + [(5, "d2", 1, 9), (5, "d2", 1, 9), (None, "x", 1, 1), (None, None, 2, 2), (7, None, 3, 3)]


def test_equals_the_changes_of_a_full_merge(spark, tmp_path):
    b = Buckets(("k",), 8)
    plain = spark.createDataFrame(target_rows(), TGT)
    target = b.write(plain, str(tmp_path / "t"))
    batch = spark.createDataFrame([(i, f"d{i % 3}", i % 5) for i in range(40, 75)] + [(5, "d2", 4), (None, "x", 8), (None, "x", 8), (7, None, 1)], "k int, d string, v int")
    for on in ("k", ["k", "d"]):
        for kw in ({}, {"update_if": T("v") != S("v")}, {"insert": None}, {"update": None}, {"set_on_update": {"n": T("n") + 1}, "set_on_insert": {"n": F.lit(0)}}):
            want = changes(merge(plain, batch, on, **kw))
            for unique in (False, True):
                got = merge_touched(target, batch, on, buckets=b, source_unique=unique, **kw)
                assert rows(got.drop(BUCKET)) == rows(want), (on, kw, unique)
                assert rows(merge_touched(plain, batch, on, source_unique=unique, **kw)) == rows(want)
    new = merge_touched(target, batch, "k", buckets=b)  # new rows carry the bucket that a later merge looks in
    assert rows(new, "k", BUCKET) == rows(b.add(new.drop(BUCKET, "_op")).filter("k is not null"), "k", BUCKET) + rows(new.filter("k is null"), "k", BUCKET)


def test_several_matches_of_one_row(spark):
    t = spark.createDataFrame([(1, "a", 10), (1, "a", 10), (2, "b", 5)], "k bigint, v string, n int")
    s = spark.createDataFrame([(1, "x", 10), (1, "y", 10), (3, "z", 1), (3, "z", 1)], "k bigint, v string, n int")
    # no match updates: matched rows stay as they are, and equal new rows come as often as they are there
    assert rows(merge_touched(t, s, "k", update_if=T("n") != S("n"))) == [(3, "z", 1, "INSERT"), (3, "z", 1, "INSERT")]
    # one of two matches updates, in both copies of the target row
    one = s.withColumn("n", F.when(F.col("v") == "y", 11).otherwise(F.col("n")))
    assert rows(merge_touched(t, one, "k", update_if=T("n") != S("n"), insert=None)) == [(1, "y", 11, "UPDATE")] * 2


@pytest.mark.parametrize("act", [lambda m: m.collect(), lambda m: m.drop("_op").collect(), lambda m: m.count(), lambda m: m.select(F.lit(1)).collect()])
@pytest.mark.parametrize("how", [merge, merge_touched])
def test_two_updates_of_one_row_fail_whatever_is_read(spark, how, act):
    t = spark.createDataFrame([(1, "a", 10)], "k bigint, v string, n int")
    s = spark.createDataFrame([(1, "x", 11), (1, "y", 12)], "k bigint, v string, n int")
    with pytest.raises(PySparkException, match="not unique"):
        act(how(t, s, "k", update_if=T("n") != S("n")))


def test_empty_sides(spark):
    t, s = spark.createDataFrame([], TGT), spark.createDataFrame([(1, "a", 2)], "k bigint, d string, v int")
    assert rows(merge_touched(t, s, "k")) == [(1, "a", 2, None, "INSERT")]
    assert rows(merge_touched(spark.createDataFrame([(1, "a", 2, 3)], TGT), s.limit(0), "k")) == []


def test_plan_reads_touched_buckets_only(spark, tmp_path):
    b = Buckets(("k",), 32)
    target = b.write(spark.range(20_000).select(F.col("id").alias("k"), F.lit("a").alias("v")), str(tmp_path / "t"))
    batch_path = str(tmp_path / "b")
    spark.createDataFrame([(3, "x"), (50_000, "y")], "k bigint, v string").write.parquet(batch_path)
    batch = spark.read.parquet(batch_path)
    for unique in (True, False):
        m = matched_rows(target, batch, "k", buckets=b, source_unique=unique)
        p = plan(m)
        assert "dynamicpruning" in p and "FullOuter" not in p and "BroadcastHashJoin" in p, p
        assert rows(m, "k", "v", "_op") == [(3, "x", "UPDATE")]
    scan = matched_rows(target, batch, "k", buckets=b, source_unique=True)
    scan.collect()
    files = [int(x.metrics().apply("numFiles").value()) for x in leaves(scan._jdf.queryExecution().executedPlan()) if "_bucket" in x.toString()]
    assert files and max(files) <= 16, files  # of 32 folders of up to 8 files


def leaves(p):
    """The scans of an executed plan, also inside the adaptive plan and its stages."""
    name = p.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return leaves(p.executedPlan())
    if name.endswith("QueryStageExec"):
        return leaves(p.plan())
    if name == "FileSourceScanExec":
        return [p]
    return [x for i in range(p.children().size()) for x in leaves(p.children().apply(i))]


def test_wide_tables_plan_quickly(spark):
    import time
    cols = [f"c{i}" for i in range(40)]
    t = spark.range(3).select(F.col("id").cast("string").alias("k"), *[F.lit("x").alias(c) for c in cols])
    b = Buckets(("k",), 8)
    start = time.time()
    matched_rows(b.add(t), t, "k", buckets=b, source_unique=True)._jdf.queryExecution().optimizedPlan()
    assert time.time() - start < 20


def test_versioned_tables_are_pruned_too(spark, tmp_path):
    from strata.sources.versioned import VersionedTables
    b, vt = Buckets(("k",), 16), VersionedTables(spark, str(tmp_path / "vt"))
    rows1 = b.add(vt.new_rows(None, spark.range(4000).select(F.col("id").alias("k"), F.lit("a").alias("v")), "k"))
    vt.commit("1", {"t": rows1}, "2024-01-01 00:00:00")
    path = str(tmp_path / "b")
    spark.createDataFrame([(3, "x"), (9000, "y")], "k bigint, v string").write.parquet(path)
    out = merge_touched(vt.read("t"), spark.read.parquet(path), "k", buckets=b, source_unique=True)
    vt.commit("2", {"t": out.filter("_op = 'UPDATE'")}, "2024-01-02 00:00:00")
    m = matched_rows(vt.read("t"), spark.read.parquet(path), "k", buckets=b, source_unique=True)
    assert "dynamicpruning" in plan(m)
    assert rows(m, "k", "v", "_op") == [(3, "x", "UPDATE")]
    files = [int(x.metrics().apply("numFiles").value()) for x in leaves(scanned(m)) if "_bucket" in x.toString()]
    assert files and max(files) < len(vt.log("t").inputFiles()) / 3, files
    feed = vt.changes("t", 1)  # the image before the update, from its own bucket
    assert "dynamicpruning" in plan(feed) and rows(feed, "k", "v", "_action") == [(3, "a", "DELETE"), (3, "x", "INSERT")]


def scanned(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan()
