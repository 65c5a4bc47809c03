"""Recipes that map the driver's test tables onto the pipeline's roles.

passenger = customer (``o_custkey``), departure airport = the customer's nation
(attributes: its region), arrival airport = ``c_mktsegment``, pilot = supplier,
ticket type = ``o_orderpriority``, passenger status = ``p_type``, flight status
= ``o_orderstatus`` ("Delayed" = ``P``), departure date = ``o_orderdate``.
The batch grain is one line item.  Change logs come from ``events`` (key
``user_id``, order ``ts``, tie-break ``event_id``).
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import write_table
from .gold import StarConfig

# Fixed values of the test recipes (run clock, user, role, batch boundaries).
RUN_TS = ["2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"]
RUN_DATE = ["2024-02-01", "2024-02-02", "2024-02-03"]
RUN_BY = "etl_user"
ORDERS_SPLIT = "1998-01-01 00:00:00"
EVENTS_SPLIT = "2024-01-16 00:00:00"
EVENTS_SNAPSHOTS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", "2024-01-31 00:00:00"]


def ts(i: int):
    return F.lit(RUN_TS[i]).cast("timestamp_ntz")


def run_date(i: int):
    return F.lit(RUN_DATE[i]).cast("date")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


STAR_CFG = StarConfig(
    passenger_key="passenger_id", passenger_attrs=["passenger_name", "account_balance"],
    airport_key="airport_name", airport_attrs=["region_key", "region_name"],
    arrival_key="arrival_airport", pilot_key="pilot_name", ticket_key="ticket_type",
    status_key="passenger_status", date_col="departure_date", flight_status="flight_status")


def star_rows(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    """Silver-like rows (one per line item) of batch 1 (orders before the split
    date), batch 2 (the rest) or both (``batch=None``, with a ``batch`` column)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                             "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey",
                                               "c_mktsegment")
    split = F.lit(ORDERS_SPLIT).cast("timestamp_ntz")
    if batch == 1:
        o = o.filter(F.col("o_orderdate") < split)      # pushed down to the orders scan
    elif batch == 2:
        o = o.filter(F.col("o_orderdate") >= split)
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # nation/region are fixed-size code tables (25 and 5 rows): broadcast is size-safe
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                      .select("n_nationkey", "n_name", "n_regionkey", "r_name"))
    # the orders get their customers before the line items, of which there are several times as many, get their orders; the
    # suppliers, which are few, come last, so that their names aren't moved with the line items
    of = o.join(c, o.o_custkey == c.c_custkey).join(geo, c.c_nationkey == geo.n_nationkey)
    rows = (li.join(p, li.l_partkey == p.p_partkey)
            .join(of, li.l_orderkey == of.o_orderkey)
            .join(s, li.l_suppkey == s.s_suppkey))
    out = rows.select(
        "l_orderkey", "l_linenumber",
        F.col("o_custkey").alias("passenger_id"),
        F.col("c_name").alias("passenger_name"),
        F.col("c_acctbal").alias("account_balance"),
        F.col("n_name").alias("airport_name"),
        F.col("n_regionkey").alias("region_key"),
        F.col("r_name").alias("region_name"),
        F.col("c_mktsegment").alias("arrival_airport"),
        F.col("s_name").alias("pilot_name"),
        F.col("o_orderpriority").alias("ticket_type"),
        F.col("p_type").alias("passenger_status"),
        F.col("o_orderstatus").alias("flight_status"),
        F.to_date("o_orderdate").alias("departure_date"),
        F.when(F.col("o_orderdate") < split, 1).otherwise(2).alias("batch"))
    return out if batch is None else out.drop("batch")


def star_batches(spark: SparkSession, sf_dir: str):
    """Batches 1 and 2 of :func:`star_rows` as written tables: the joins run once for both.  Orders without a date are in neither."""
    rows = star_rows(spark, sf_dir).filter(F.col("departure_date").isNotNull())
    rows = write_table(rows, scratch_path(spark, "star-batches"), partition_by=["batch"])
    return [rows.filter(F.col("batch") == i) for i in (1, 2)]


def overlapping_batches(spark: SparkSession, sf_dir: str):
    """Two batches that meet: a third of the orders are in both.  In the second, customers' balances, a region's name and the
    status of some orders have changed, and some flights have been moved by three days."""
    rows = star_rows(spark, sf_dir)
    k = F.col("l_orderkey")
    second = rows.filter(k % 3 != 1).withColumns({
        "account_balance": F.when(F.col("passenger_id") % 5 == 0, F.col("account_balance") + 1000).otherwise(F.col("account_balance")),
        "region_name": F.when(F.col("region_key") == 2, F.concat("region_name", F.lit("*"))).otherwise(F.col("region_name")),
        "flight_status": F.when(k % 4 == 0, "P").otherwise(F.col("flight_status")),
        "departure_date": F.when(k % 7 == 0, F.date_add("departure_date", 3)).otherwise(F.col("departure_date"))})
    return [rows.filter(k % 3 != 0), second]


#: The same as a CTE ``b`` with ``batch``; ``r`` are the rows of :func:`star_rows`.
OVERLAP_SQL = """
b AS (SELECT * REPLACE (1 AS batch) FROM r WHERE l_orderkey % 3 <> 0 UNION ALL
      SELECT * REPLACE (2 AS batch, CASE WHEN passenger_id % 5 = 0 THEN account_balance + 1000 ELSE account_balance END AS account_balance,
               CASE WHEN region_key = 2 THEN region_name || '*' ELSE region_name END AS region_name,
               CASE WHEN l_orderkey % 4 = 0 THEN 'P' ELSE flight_status END AS flight_status,
               CASE WHEN l_orderkey % 7 = 0 THEN CAST(departure_date + INTERVAL 3 DAY AS DATE) ELSE departure_date END AS departure_date)
      FROM r WHERE l_orderkey % 3 <> 1)"""
