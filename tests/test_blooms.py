"""Key checks by Bloom filters: exact results, few false hits, and no read of history for keys that are new."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.blooms import KeyFilter, duplicate_keys_of_batch, orphans_of_batch
from strata.operators.quality import duplicate_keys, orphans
from strata.operators.touched import BUCKET, Buckets
from test_touched import leaves

SCHEMA = "a bigint, b string, v int"


@pytest.mark.parametrize("bits", [64, 1 << 12])  # full and sparse: many false hits and few
def test_duplicates_and_orphans_are_exact(spark, tmp_path, bits):
    flt = KeyFilter(Buckets(("a", "b"), 4), bits=bits, hashes=3)
    old = spark.createDataFrame([(i % 90, f"x{i % 4}", i) for i in range(120)] + [(None, "x1", 1), (3, None, 2)], SCHEMA)
    new = spark.createDataFrame([(i, f"x{i % 4}", i) for i in range(80, 140)] + [(500, "n", 1)] * 2 + [(None, None, 1), (3, None, 5)], "a int, b string, v int")
    table = flt.buckets.write(old, str(tmp_path / "t"))
    words = flt.extend(flt.words(old.filter("v < 50")), old.filter("v >= 50"))
    assert rows(words) == rows(flt.words(old))
    got = duplicate_keys_of_batch(table, words, new, flt)
    keys = new.select("a", "b").distinct()
    both = old.filter("a is not null and b is not null").select("a", "b").unionByName(new.select("a", "b"))
    want = duplicate_keys(both, ["a", "b"]).join(keys, F.expr("true") & both["a"].eqNullSafe(keys["a"]) & both["b"].eqNullSafe(keys["b"]), "left_semi")
    assert rows(got) == rows(want)
    assert rows(orphans_of_batch(new, table, words, flt, ["a", "b"])) == rows(orphans(new, old, ["a", "b"]))


def test_filter_misses_no_key_and_hits_few_others(spark):
    flt = KeyFilter(Buckets(("a",), 8), bits=1 << 13, hashes=5)
    words = flt.words(spark.range(5000).select(F.col("id").alias("a")))
    assert flt.possible(words, spark.range(5000).select(F.col("id").alias("a"))).count() == 5000
    assert flt.possible(words, spark.range(10_000, 20_000).select(F.col("id").alias("a"))).count() < 300  # about 0.9 % expected


def test_new_keys_open_no_file_of_history(spark, tmp_path):
    flt = KeyFilter(Buckets(("a",), 8), bits=1 << 16)
    table = flt.buckets.write(spark.range(2000).select(F.col("id").alias("a"), F.lit("v").alias("v")), str(tmp_path / "t"))
    words = flt.words(table)
    got = duplicate_keys_of_batch(table, words, spark.range(5000, 5100).select(F.col("id").alias("a")), flt)
    assert got.collect() == []
    opened = [int(x.metrics().apply("numFiles").value()) for x in leaves(got._jdf.queryExecution().executedPlan()) if BUCKET in x.toString()]
    assert sum(opened) == 0, opened
