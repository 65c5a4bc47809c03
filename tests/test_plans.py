"""Plan shape checks: the scale properties the operators rely on."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from conftest import SF
from strata.operators.dims import unique_source
from strata.operators.latest import latest_per_key
from strata.operators.merge import S, T, merge
from strata.operators.quality import duplicate_keys
from strata.plans.gold import empty_state
from strata.plans.testdata import STAR_CFG, star_rows


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def skewed(spark, n=30000):
    # one key holds a third of all rows
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("ts"), (F.col("id") % 7).cast("string").alias("v"))


def test_latest_per_key_limits_before_shuffle(spark):
    df = latest_per_key(skewed(spark), "k", "ts", ["v"])
    p = plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p
    assert df.filter("k = 0").count() == 1


def test_dedup_and_key_checks_aggregate_map_side(spark):
    df = skewed(spark)
    for out in (duplicate_keys(df, "k"), unique_source(df.select("k", F.lit("x").alias("a")), "k", ["a"])):
        p = plan(out)
        assert "partial_" in p, p


def test_large_source_merge_spreads_null_keys(spark):
    target = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
                                      F.lit("a").alias("v"))
    source = target.withColumn("v", F.lit("b"))
    m = merge(target, source, "k", check_unique=False, source_unique=True)
    assert "__salt_t" in plan(m)
    got = {r["_op"]: r["n"] for r in m.groupBy("_op").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"UPDATE": 500, None: 500, "INSERT": 500}


def test_unique_source_hashes_the_batch_before_it_sorts(spark):
    p = plan(unique_source(skewed(spark), "k", ["v"]))
    # the distinct rows, map-side and after the shuffle; the minimum of a struct, a sort aggregation, is taken of these
    assert p.count("HashAggregate(keys=[k") == 2, p


def test_conditional_merge_numbers_neither_side(spark):
    target = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    source = spark.range(50, 150).select(F.col("id").alias("k"), F.lit(2).alias("n"))
    m = merge(target, source, "k", update_if=T("n") != S("n"))
    assert "ExistingRDD" not in plan(m) and "SortAggregate" not in plan(m)
    assert {r["_op"]: r["count"] for r in m.groupBy("_op").count().collect()} == {None: 50, "UPDATE": 50, "INSERT": 50}


def test_merge_into_an_empty_table_joins_nothing(spark):
    fact = empty_state(spark, star_rows(spark, SF).schema, STAR_CFG)["fact_flight_data"]
    source = spark.range(10).select(F.col("id").cast("int").alias("update_count"), F.lit("x").alias("flight_status"))
    m = merge(fact, source, "update_count", update_if=T("flight_status") != S("flight_status"))
    m.collect()
    assert "Join" not in plan(m) and m.filter("_op = 'INSERT'").count() == 10
