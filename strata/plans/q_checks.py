"""Checks of a batch against what was loaded before (G-5, G-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.blooms import KeyFilter, duplicate_keys_of_batch, orphans_of_batch
from ..operators.touched import Buckets
from ..session import scratch_path
from ..sources.tables import write_table
from .registry import query
from .testdata import ORDERS_SPLIT, table


def split(df, column):
    at = F.lit(ORDERS_SPLIT).cast("timestamp_ntz")
    return df.filter(F.col(column) < at), df.filter(F.col(column) >= at)


@query("pk_check_incremental", """
WITH k AS (SELECT l_orderkey, CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber, l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AS late FROM lineitem)
SELECT l_orderkey, l_linenumber, count(*) FILTER (WHERE late OR l_linenumber IS NOT NULL) AS n FROM k GROUP BY l_orderkey, l_linenumber
HAVING bool_or(late) AND (n > 1 OR l_linenumber IS NULL)""")
def q_pk_check_incremental(spark, sf_dir):
    """Late lines whose key is null or was there before, in the batch or in history, which is read for possible hits only."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_orderkey") % 997 != 0, F.col("l_linenumber")).alias("l_linenumber"), "l_shipdate")
    old, new = split(li, "l_shipdate")
    flt, root = KeyFilter(Buckets(("l_orderkey", "l_linenumber"), 16)), scratch_path(spark, "pk")
    history = flt.buckets.write(old.drop("l_shipdate"), f"{root}/history")
    return duplicate_keys_of_batch(history, write_table(flt.words(history), f"{root}/filter"), write_table(new, f"{root}/batch"), flt)


@query("fk_check_incremental", """
WITH f AS (SELECT l_orderkey AS line, l_linenumber, l_suppkey, CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS order_fk
           FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00')
SELECT line, l_linenumber, l_suppkey, order_fk FROM f WHERE order_fk IS NOT NULL AND order_fk NOT IN (SELECT o_orderkey FROM orders)""")
def q_fk_check_incremental(spark, sf_dir):
    """Late lines that refer to no order; the filter of the orders was built in two loads."""
    _, new = split(table(spark, sf_dir, "lineitem"), "l_shipdate")
    k = F.col("l_orderkey")
    batch = new.select(k.alias("line"), "l_linenumber", "l_suppkey", F.when(k % 103 == 0, None).when(k % 101 == 0, k + 1_000_000_000).otherwise(k).alias("order_fk"))
    flt, root = KeyFilter(Buckets(("o_orderkey",), 16)), scratch_path(spark, "fk")
    first, second = split(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    dim = flt.buckets.write(first.unionByName(second).drop("o_orderdate"), f"{root}/dim")
    words = write_table(flt.words(first), f"{root}/first")
    words = write_table(flt.extend(words, second), f"{root}/second")
    return orphans_of_batch(batch, dim, words, flt, "order_fk")
