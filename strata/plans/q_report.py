"""The status report kept by the changes of its sources (D-8, B-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.access import create_policy, read_as, secure_view, use_role
from ..operators.cdc import diff_snapshots
from ..operators.dims import apply_changes
from ..operators.reports import ReportJoin, report_changes, report_table, status_report
from ..session import scratch_path
from ..sources.tables import write_table
from .registry import query
from .testdata import table


def sources(spark, sf_dir, batch):
    """(fact, nations, customers) after a batch.  The first has the orders before 1998 and lacks some customers; the second adds the
    rest, changes the status or the date of some orders, drops others, and renames, adds and drops dimension rows."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("departure_date"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    k = F.col("o_orderkey")
    fact = o.join(c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_fk")), "o_custkey")
    if batch == 1:
        return (fact.filter("departure_date < date'1998-01-01'"), n.filter("n_nationkey <> 3").drop("n_regionkey"), c.filter("c_custkey % 50 <> 0").drop("c_nationkey"))
    status = F.when(k % 10 == 0, "P").when(k % 10 == 1, "F").otherwise(F.col("o_orderstatus"))
    date = F.when(k % 10 == 2, F.date_add("departure_date", 7)).otherwise(F.col("departure_date"))
    fact = fact.filter(k % 23 != 0).withColumns({"o_orderstatus": status, "departure_date": date})
    n = n.filter("n_nationkey <> 7").withColumn("n_name", F.when(F.col("n_regionkey") == 1, F.concat("n_name", F.lit(" (new)"))).otherwise(F.col("n_name"))).drop("n_regionkey")
    c = c.filter("c_custkey % 33 <> 0").withColumn("c_name", F.when(F.col("c_custkey") % 20 == 0, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name"))).drop("c_nationkey")
    return fact, n, c


def report_joins(n, c):
    return [ReportJoin(n, "n_nationkey", "nation_fk", {"n_name": "departure_airport"}),
            ReportJoin(c, "c_custkey", "o_custkey", {"c_name": "passenger_name", "c_mktsegment": "arrival_airport"})]


KEYS = ["o_orderkey", "n_nationkey", "c_custkey"]
KEPT = {"status_col": "o_orderstatus", "fact_cols": ["departure_date"]}

REPORT_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, c_nationkey AS nation_fk, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey),
f AS (SELECT 1 AS batch, * FROM o WHERE d < DATE '1998-01-01' UNION ALL
      SELECT 2, o_orderkey, o_custkey, nation_fk, CASE o_orderkey % 10 WHEN 0 THEN 'P' WHEN 1 THEN 'F' ELSE st END, CASE WHEN o_orderkey % 10 = 2 THEN CAST(d + INTERVAL 7 DAY AS DATE) ELSE d END
      FROM o WHERE o_orderkey % 23 <> 0),
n AS (SELECT 1 AS batch, n_nationkey, n_name FROM nation WHERE n_nationkey <> 3 UNION ALL
      SELECT 2, n_nationkey, CASE WHEN n_regionkey = 1 THEN n_name || ' (new)' ELSE n_name END FROM nation WHERE n_nationkey <> 7),
c AS (SELECT 1 AS batch, c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 50 <> 0 UNION ALL
      SELECT 2, c_custkey, CASE WHEN c_custkey % 20 = 0 THEN c_name || '*' ELSE c_name END, c_mktsegment FROM customer WHERE c_custkey % 33 <> 0),
r AS (SELECT f.batch, n_name AS departure_airport, c_name AS passenger_name, c_mktsegment AS arrival_airport, o_orderkey, nation_fk, o_custkey, d AS departure_date
      FROM f LEFT JOIN n ON f.batch = n.batch AND nation_fk = n_nationkey LEFT JOIN c ON f.batch = c.batch AND o_custkey = c_custkey WHERE st = 'P')
"""


def kept_report(spark, sf_dir):
    """The report after each of two batches, kept by changes from empty, and the change rows of the second."""
    root = scratch_path(spark, "report")
    state, report, states = None, None, []
    for b in (1, 2):
        now = [write_table(df, f"{root}/{k}{b}") for df, k in zip(sources(spark, sf_dir, b), KEYS)]
        was = state or [df.limit(0) for df in now]
        feeds = [write_table(diff_snapshots(old, new, k), f"{root}/feed-{k}{b}") for old, new, k in zip(was, now, KEYS)]
        joins = report_joins(*now[1:])
        if report is None:
            report = report_table(was[0], "P", joins, "o_orderkey", **KEPT)
        changes = write_table(report_changes(report, feeds[0], {0: feeds[1], 1: feeds[2]}, "P", joins, "o_orderkey", **KEPT), f"{root}/changes{b}")
        report = write_table(apply_changes(report, changes, "o_orderkey"), f"{root}/report{b}")
        states.append(report.select(F.lit(b).alias("batch"), "*"))
        state = now
    return states, changes


@query("report_incremental", REPORT_SQL + "SELECT * FROM r")
def q_report_incremental(spark, sf_dir):
    states, _ = kept_report(spark, sf_dir)
    return states[0].unionByName(states[1])


@query("report_changes", REPORT_SQL + """
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'INSERT' WHEN b.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS _op
FROM (SELECT * FROM r WHERE batch = 1) a FULL JOIN (SELECT * FROM r WHERE batch = 2) b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.departure_airport IS DISTINCT FROM b.departure_airport OR a.passenger_name IS DISTINCT FROM b.passenger_name
   OR a.arrival_airport IS DISTINCT FROM b.arrival_airport OR a.departure_date IS DISTINCT FROM b.departure_date""")
def q_report_changes(spark, sf_dir):
    """The second batch's changes: rows that enter, leave or look different, and no others."""
    _, changes = kept_report(spark, sf_dir)
    return changes.select("o_orderkey", "_op")


@query("secure_report", REPORT_SQL + """
SELECT 'AIRLINE_ROLE' AS seen_by, departure_airport, passenger_name, o_orderkey, o_custkey FROM r WHERE batch = 1
UNION ALL SELECT 'DATA_ANALYST (urgent)', departure_airport, passenger_name, o_orderkey, o_custkey FROM r WHERE batch = 1 AND arrival_airport = 'BUILDING'""")
def q_secure_report(spark, sf_dir):
    """The report as a view with the row policy attached, read under two roles that may see it and one that may not (G-7, D-8)."""
    fact, n, c = sources(spark, sf_dir, 1)
    use_role(spark, "PUBLIC")
    create_policy(spark, "delayed_report_policy", key_type="bigint")
    report = status_report(fact, "P", report_joins(n, c), status_col="o_orderstatus", fact_cols=["o_orderkey", "o_custkey"])
    secure_view(spark, "delayed_report", report, "delayed_report_policy", "o_custkey")
    cols = ["departure_airport", "passenger_name", "o_orderkey", "o_custkey"]
    seen = [read_as(spark, "delayed_report", role).select(F.lit(role).alias("seen_by"), *cols) for role in ("AIRLINE_ROLE", "PUBLIC")]
    use_role(spark, "DATA_ANALYST")
    analyst = spark.sql("SELECT 'DATA_ANALYST (urgent)' AS seen_by, departure_airport, passenger_name, o_orderkey, o_custkey FROM delayed_report WHERE arrival_airport = 'BUILDING'")
    use_role(spark, "PUBLIC")
    return seen[0].unionByName(seen[1]).unionByName(analyst)
