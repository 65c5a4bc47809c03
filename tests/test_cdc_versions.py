import pytest
from pyspark.sql import functions as F

from conftest import rows, srt
from strata.operators.cdc import diff_snapshots, has_changes, net_changes
from strata.session import scratch_path
from strata.sources.versioned import OP, VersionedTables

S = "k bigint, v string"


def apply(feed, old, key="k"):
    dels = feed.filter("_action = 'DELETE'").select(key)
    ins = feed.filter("_action = 'INSERT'").drop("_action", "_is_update")
    return old.join(dels, key, "left_anti").unionByName(ins)


def test_diff_then_apply_gives_new(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], S)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (4, "d")], S)
    feed = diff_snapshots(old, new, "k")
    assert rows(feed) == srt([(2, "B", "INSERT", True), (2, "b", "DELETE", True), (3, None, "DELETE", True),
                              (3, "c", "INSERT", True), (4, "d", "INSERT", False)])
    assert rows(apply(feed, old)) == rows(new)
    assert has_changes(feed).first()[0] is True
    assert has_changes(diff_snapshots(new, new, "k")).first()[0] is False


def test_net_changes_fold(spark):
    v0 = spark.createDataFrame([(1, "a"), (2, "b")], S)
    v1 = spark.createDataFrame([(1, "x"), (2, "b"), (3, "c")], S)
    v2 = spark.createDataFrame([(1, "a"), (3, "c2")], S)  # 1 changed back, 2 deleted, 3 inserted then changed
    log = (diff_snapshots(v0, v1, "k").withColumn("_version", F.lit(1))
           .unionByName(diff_snapshots(v1, v2, "k").withColumn("_version", F.lit(2))))
    assert rows(net_changes(log, "k", 0, 2)) == rows(diff_snapshots(v0, v2, "k"))


def test_versioned_crash_replay_clone(spark):
    vt = VersionedTables(spark, scratch_path(spark, "t-versions"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], S)
    vt.commit("b1", {"t": vt.new_rows(None, df, "k")}, "2024-01-01 00:00:00")
    w = {"t": vt.delete_rows("t", F.col("k") == 1)}
    with pytest.raises(RuntimeError):
        vt.commit("b2", w, "2024-01-02 00:00:00", fail_before_commit=True)
    assert rows(vt.data("t")) == [(1, "a"), (2, "b")]          # readers see the old version
    assert vt.commit("b2", w, "2024-01-02 00:00:00") == 2
    assert vt.commit("b2", w, "2024-01-02 00:00:00") == 2       # replay is a no-op
    assert rows(vt.data("t")) == srt([(2, "b")])
    assert rows(vt.data("t", 1)) == srt([(1, "a"), (2, "b")])
    assert rows(vt.data("t", ts="2024-01-02 00:00:00", before=True)) == srt([(1, "a"), (2, "b")])
    assert rows(vt.data("t", vt.head())) == rows(vt.data("t"))  # as_of(head) = current
    vt.commit("c", {}, "2024-01-03 00:00:00", clones={"t2": ("t", 1)})
    vt.commit("d", {"t2": vt.delete_rows("t2", F.col("k") == 2)}, "2024-01-03 00:00:00")
    assert rows(vt.data("t2")) == srt([(1, "a")])
    assert rows(vt.data("t")) == [(2, "b")]                     # the parent is untouched
    feed = vt.changes("t", 1, 2)
    assert rows(feed, "k", "_action") == srt([(1, "DELETE")])


def test_compaction_keeps_state_and_feed(spark):
    vt = VersionedTables(spark, scratch_path(spark, "t-compact"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], S)
    vt.commit("b1", {"t": vt.new_rows(None, df, "k")}, "2024-01-01 00:00:00")
    vt.commit("b2", {"t": vt.update_rows("t", {"v": F.lit("z")}, F.col("k") == 1)}, "2024-01-02 00:00:00")
    before = rows(vt.data("t"))
    vt.compact("t", "c1", "2024-01-03 00:00:00")
    vt.commit("b3", {"t": vt.delete_rows("t", F.col("k") == 2)}, "2024-01-04 00:00:00")
    assert rows(vt.data("t", 3)) == before
    assert rows(vt.data("t")) == srt([(1, "z"), (3, "c")])
    assert rows(vt.data("t", 1)) == srt([(1, "a"), (2, "b"), (3, "c")])
    assert rows(vt.changes("t", 2, 4), "k", "_action") == [(2, "DELETE")]


def test_failed_batch_leaves_nothing_behind(spark):
    """A batch dies after its first table, an unrelated table commits, then the batch is replayed."""
    vt = VersionedTables(spark, scratch_path(spark, "leak"))
    row = lambda i: spark.createDataFrame([(i, "x", "INSERT")], "_row_id bigint, v string, _op string")
    vt.commit("b0", {"dim": row(1)}, "2024-01-01 00:00:00")
    with pytest.raises(RuntimeError):
        vt.commit("b1", {"dim": row(2), "fact": row(2)}, "2024-01-02 00:00:00", fail_before_commit=True)
    vt.commit("other", {"audit": row(9)}, "2024-01-03 00:00:00")
    assert [r[0] for r in vt.read("dim").select("_row_id").collect()] == [1]
    vt.commit("b1", {"dim": row(2), "fact": row(2)}, "2024-01-04 00:00:00")
    assert sorted(r[0] for r in vt.read("dim").select("_row_id").collect()) == [1, 2]
    assert vt.log("dim").count() == 2


def test_insert_only_feed_reads_only_its_versions(spark, tmp_path):
    vt = VersionedTables(spark, str(tmp_path / "feed"))
    for i in (1, 2, 3):
        vt.commit(f"b{i}", {"t": vt.new_rows("t", spark.createDataFrame([(i, "a"), (i + 10, "b")], "k int, v string"), "k")},
                  f"2024-01-0{i} 00:00:00")
    feed = vt.changes("t", 2)
    assert all("version=3" in f for f in feed.inputFiles())
    assert rows(feed, "k", "_action", "_is_update") == srt([(3, "INSERT", False), (13, "INSERT", False)])
    assert [r["rows"] for r in vt.commits().orderBy("version").collect()] == [2, 2, 2]
    vt.commit("d", {"t": vt.delete_rows("t", F.col("k") >= 3)}, "2024-01-04 00:00:00")
    assert rows(vt.changes("t", 3), "k", "_action") == srt([(3, "DELETE"), (11, "DELETE"), (12, "DELETE"), (13, "DELETE")])
    vt.compact("t", "c", "2024-01-05 00:00:00")
    vt.commit("b4", {"t": vt.new_rows("t", spark.createDataFrame([(99, "z")], "k int, v string"), "k")}, "2024-01-06 00:00:00")
    assert vt.max_row_id("t") == 7  # ids of deleted rows aren't given again


def test_a_clone_is_new_to_earlier_consumers(spark, tmp_path):
    vt = VersionedTables(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, v string")
    vt.commit("1", {"t": vt.new_rows(None, df, "k")}, "2024-01-01 00:00:00")
    vt.commit("2", {}, "2024-01-02 00:00:00", clones={"c": ("t", 1)})
    vt.commit("3", {"c": vt.delete_rows("c", F.col("k") == 1)}, "2024-01-03 00:00:00")
    vt.commit("4", {"c": vt.update_rows("c", {"v": F.lit("z")}, F.col("k") == 2)}, "2024-01-04 00:00:00")
    assert rows(vt.changes("c", 0), "k", "v", "_action") == [(2, "z", "INSERT"), (3, "c", "INSERT")]
    assert rows(vt.changes("c", 0, 2), "k") == [(1,), (2,), (3,)]
    assert rows(vt.changes("c", 2), "k", "_action", "_is_update") == rows(spark.createDataFrame(
        [(1, "DELETE", False), (2, "DELETE", True), (2, "INSERT", True)], "k bigint, a string, u boolean"))
    assert vt.read("c", 1).count() == 0 and vt.read("c", 2).count() == 3
