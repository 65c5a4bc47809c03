"""The diff by digests equals the plain one and opens only the folders that differ."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.cdc import diff_snapshots
from strata.operators.digests import diff_digested, differing_buckets, digest_rows, write_digested
from strata.operators.touched import BUCKET, Buckets
from test_touched import leaves

SCHEMA = "k bigint, a string, b string, x double"


def snapshots(spark, change):
    base = [(i, f"a{i % 5}", None if i % 3 else "b", float(i)) for i in range(400)]
    return spark.createDataFrame(base, SCHEMA).repartition(3), spark.createDataFrame(change(dict((r[0], r) for r in base)), SCHEMA)


CHANGES = {
    "none": lambda d: list(d.values())[::-1],
    "value moves beside a null": lambda d: list((d | {7: (7, None, d[7][1], 7.0)}).values()),
    "update, delete, insert": lambda d: [r for r in (d | {5: (5, "z", None, 1.0), 900: (900, "n", "n", None)}).values() if r[0] != 8],
    "two rows swap their values": lambda d: list((d | {1: (1, *d[2][1:]), 2: (2, *d[1][1:])}).values()),
    "all gone": lambda d: [],
}


@pytest.mark.parametrize("change", CHANGES)
def test_equals_a_plain_diff(spark, tmp_path, change):
    old, new = snapshots(spark, CHANGES[change])
    b = Buckets(("k",), 32)
    o, n = write_digested(old, str(tmp_path / "o"), b), write_digested(new, str(tmp_path / "n"), b)
    got, want = diff_digested(o, n, "k", fanout=4), diff_snapshots(old, new, "k")
    assert rows(got) == rows(want)
    hit = {r[BUCKET] for r in differing_buckets(o.digests, n.digests, 32, fanout=4).collect()}
    assert hit == {r[BUCKET] for r in b.add(want.select("k")).select(BUCKET).collect()}
    opened = [int(x.metrics().apply("numFiles").value()) for x in leaves(got._jdf.queryExecution().executedPlan()) if BUCKET in x.toString()]
    files = len(o.rows.inputFiles()) + len(n.rows.inputFiles())
    assert sum(opened) <= files * len(hit) / 8, (opened, files)


def test_digests_add_up_in_any_order(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("a"))
    one = digest_rows(df, ["k", "a"], []).first()
    assert one == digest_rows(df.orderBy(F.rand(1)).repartition(5), ["k", "a"], []).first() and one["rows"] == 1000
    assert one != digest_rows(df.filter("k > 0"), ["k", "a"], []).first()


def test_different_buckets_are_refused(spark, tmp_path):
    old, new = snapshots(spark, CHANGES["none"])
    with pytest.raises(ValueError, match="different buckets"):
        diff_digested(write_digested(old, str(tmp_path / "o"), Buckets(("k",), 4)), write_digested(new, str(tmp_path / "n"), Buckets(("k",), 8)), "k")
