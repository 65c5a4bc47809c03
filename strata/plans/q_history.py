"""History queries: facts bound to the version valid at their time (D-6, J-2), and versions from late batches (D-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dims import apply_changes, scd2_from_history
from ..operators.fact import Lookup, star_lookup
from ..operators.keys import assign_keys
from ..operators.late import SEEN, scd2_late
from ..session import scratch_path
from ..sources.tables import write_table
from .q_dims import banded, scd2_batches
from .q_silver import events
from .registry import ORACLES, query
from .testdata import table

CUSTOMER_VERSIONS = """
o AS (SELECT o_custkey, o_orderpriority, o_orderstatus, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('quarter', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
c AS (SELECT *, row_number() OVER w AS rn, lag(o_orderpriority) OVER w AS p, lag(o_orderstatus) OVER w AS s FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY q)),
v AS (SELECT CAST(row_number() OVER (ORDER BY o_custkey, q) AS BIGINT) AS customer_sk, o_custkey, o_orderpriority, q AS eff,
             lead(q) OVER (PARTITION BY o_custkey ORDER BY q) AS expi FROM c
      WHERE rn = 1 OR p IS DISTINCT FROM o_orderpriority OR s IS DISTINCT FROM o_orderstatus)
"""


def customer_versions(spark, sf_dir):
    """Customers whose priority and status change: the last order of each quarter tells what holds from its start on."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    v = scd2_from_history(o, "o_custkey", ["o_orderpriority", "o_orderstatus"], "o_orderdate", ["o_orderkey"],
                          period=F.to_date(F.date_trunc("quarter", "o_orderdate")))
    return write_table(assign_keys(v, "customer_sk", ["o_custkey", "effective_date"]), scratch_path(spark, "versions"))


@query("fact_point_in_time", f"""WITH {CUSTOMER_VERSIONS}
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, o.o_custkey, CAST(l.l_shipdate AS DATE) AS ship_date, v.customer_sk, v.o_orderpriority AS priority_then
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN v ON v.o_custkey = o.o_custkey AND CAST(l.l_shipdate AS DATE) >= v.eff AND (v.expi IS NULL OR CAST(l.l_shipdate AS DATE) < v.expi)""")
def q_fact_point_in_time(spark, sf_dir):
    """Every line binds to the version of its customer that was valid when it was shipped."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.to_date("l_shipdate").alias("ship_date"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    dim = customer_versions(spark, sf_dir).withColumnRenamed("o_orderpriority", "priority_then")
    return star_lookup(li.join(o, "l_orderkey"), [Lookup(dim, {"o_custkey": "o_custkey"}, "customer_sk", as_of="ship_date", extra=["priority_then"])])


def late_batches(spark, batches):
    """(versions, observations) after the batches, in the order given; each state is a written table."""
    root = scratch_path(spark, "late")
    dim = spark.createDataFrame([], "user_sk bigint, user_id bigint, event_type string, band int, effective_date date, expiry_date date, current_flag boolean")
    obs = spark.createDataFrame([], f"user_id bigint, effective_date date, event_type string, band int, {SEEN} struct<ts: timestamp_ntz, event_id: bigint>")
    for i, b in enumerate(batches):
        changes, splits = scd2_late(dim, obs, b, "user_id", ["event_type", "band"], "ts", ["event_id"], "user_sk")
        dim = write_table(apply_changes(dim, changes, "user_sk"), f"{root}/dim{i}")
        obs = write_table(apply_changes(obs, splits, ["user_id", "effective_date"]), f"{root}/obs{i}")
    return dim, obs


@query("scd2_late", ORACLES["scd2_history"])
def q_scd2_late(spark, sf_dir):
    """The last ten days come first, then the first ten, then those between: the history is that of all events in order."""
    first, second, third = scd2_batches(spark, sf_dir)
    return late_batches(spark, [third, first, second])[0].drop("user_sk")


@query("scd2_late_replay", ORACLES["scd2_history"])
def q_scd2_late_replay(spark, sf_dir):
    """Batches that overlap (each event type is a batch, and all events come once more at the end) end in the same history."""
    e = banded(events(spark, sf_dir))
    quiet = F.col("event_type").isin("view", "click")
    return late_batches(spark, [e.filter(~quiet), e.filter(quiet), e])[0].drop("user_sk")
