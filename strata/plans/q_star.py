"""Gold star-schema queries on the test tables (D-1 ... D-8, J-1 ... J-6, M-2)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators.dims import role_view
from ..operators.reports import ReportJoin, status_report
from ..session import scratch_path
from ..sources.tables import write_table
from .gold import empty_state, fact_source, load_dims, merge_fact
from .registry import query
from .testdata import OVERLAP_SQL, STAR_CFG, overlapping_batches, run_date, star_batches, table, ts


def run_star(spark, sf_dir, cfg=STAR_CFG, lookups_out=False, facts=True, batches=star_batches):
    """Two gold batches; every table of each batch is written to the shared
    folder (lineage cut, survives executor loss) before the next batch.
    Without ``facts`` only the dimensions are loaded and the fact stays empty."""
    root = scratch_path(spark, "star")
    b1, b2 = (b.drop("batch") for b in batches(spark, sf_dir))
    state = empty_state(spark, b1.schema, cfg)
    ids = ("l_orderkey", "l_linenumber") if lookups_out else ()
    looked = []
    for i, b in enumerate((b1, b2)):
        state = load_dims(state, b, cfg, run_date(i), root=f"{root}/v{i + 1}")
        found = fact_source(state, b, cfg, keep=ids)
        if lookups_out:
            # the fact takes the lookups that come out: they run once
            looked.append(write_table(found, f"{root}/lookups{i + 1}") if facts else found)
            found = looked[-1].drop(*ids)
        if facts:
            state, _ = merge_fact(state, found, cfg, ts(i), root=f"{root}/v{i + 1}")
    return (state, looked) if lookups_out else state


def overlapping_tables(spark, sf_dir):
    root = scratch_path(spark, "star-batches")
    return [write_table(b, f"{root}/{i}") for i, b in enumerate(overlapping_batches(spark, sf_dir))]


# Shared oracle CTEs: the batch rows and the dimensions after both batches.
STAR_CTE = """
b AS (
  SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS passenger_id, c.c_name AS passenger_name,
         c.c_acctbal AS account_balance, n.n_name AS airport_name, n.n_regionkey AS region_key,
         r.r_name AS region_name, c.c_mktsegment AS arrival_airport, s.s_name AS pilot_name,
         o.o_orderpriority AS ticket_type, p.p_type AS passenger_status, o.o_orderstatus AS flight_status,
         CAST(o.o_orderdate AS DATE) AS departure_date,
         CASE WHEN o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END AS batch
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey),
dim_pilot AS (SELECT CAST(row_number() OVER (ORDER BY fb, pilot_name) AS BIGINT) AS pilot_sk, pilot_name
  FROM (SELECT pilot_name, min(batch) AS fb FROM b GROUP BY pilot_name)),
dim_ticket_type AS (SELECT CAST(row_number() OVER (ORDER BY fb, ticket_type) AS BIGINT) AS ticket_sk, ticket_type
  FROM (SELECT ticket_type, min(batch) AS fb FROM b GROUP BY ticket_type)),
dim_passenger_status AS (SELECT CAST(row_number() OVER (ORDER BY fb, passenger_status) AS BIGINT) AS pass_status_sk,
  passenger_status FROM (SELECT passenger_status, min(batch) AS fb FROM b GROUP BY passenger_status)),
dim_arrival_airport AS (SELECT CAST(row_number() OVER (ORDER BY fb, airport_code) AS BIGINT) AS arrival_airport_sk,
  airport_code FROM (SELECT arrival_airport AS airport_code, min(batch) AS fb FROM b GROUP BY arrival_airport)),
dim_airport AS (SELECT CAST(row_number() OVER (ORDER BY fb, airport_name) AS BIGINT) AS airport_sk, airport_name,
  region_key, region_name FROM (SELECT airport_name, min(batch) AS fb, max_by(region_key, batch) AS region_key,
  max_by(region_name, batch) AS region_name FROM b GROUP BY airport_name)),
dim_passenger AS (SELECT CAST(row_number() OVER (ORDER BY fb, passenger_id) AS BIGINT) AS passenger_sk, passenger_id,
  passenger_name, account_balance,
  CASE WHEN fb = 1 THEN DATE '2024-02-01' ELSE DATE '2024-02-02' END AS effective_date,
  CAST(NULL AS DATE) AS expiry_date, TRUE AS current_flag
  FROM (SELECT passenger_id, passenger_name, account_balance, min(batch) AS fb FROM b
        GROUP BY passenger_id, passenger_name, account_balance)),
looked AS (
  SELECT b.l_orderkey, b.l_linenumber, p.passenger_sk, a.airport_sk AS departure_airport_sk,
         aa.arrival_airport_sk, pi.pilot_sk, t.ticket_sk, ps.pass_status_sk, b.departure_date,
         b.flight_status, b.passenger_id, b.batch
  FROM b LEFT JOIN dim_passenger p ON b.passenger_id = p.passenger_id AND p.current_flag
  LEFT JOIN dim_airport a ON b.airport_name = a.airport_name
  LEFT JOIN dim_arrival_airport aa ON b.arrival_airport = aa.airport_code
  LEFT JOIN dim_pilot pi ON b.pilot_name = pi.pilot_name
  LEFT JOIN dim_ticket_type t ON b.ticket_type = t.ticket_type
  LEFT JOIN dim_passenger_status ps ON b.passenger_status = ps.passenger_status),
src AS (SELECT DISTINCT passenger_sk, departure_airport_sk, arrival_airport_sk, pilot_sk, ticket_sk,
        pass_status_sk, departure_date, flight_status, passenger_id, batch FROM looked),
fact AS (
  SELECT s.passenger_sk, s.departure_airport_sk, s.arrival_airport_sk, s.pilot_sk, s.ticket_sk,
         s.pass_status_sk, s.passenger_id, s.flight_status, s.departure_date AS original_departure_date,
         s.departure_date AS current_departure_date, CAST(0 AS INTEGER) AS update_count,
         CASE WHEN s.batch = 1 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-02-02 00:00:00' END
           AS last_record_update
  FROM src s
  WHERE s.batch = 1 OR NOT EXISTS (
    SELECT 1 FROM src f WHERE f.batch = 1 AND f.passenger_id = s.passenger_id
      AND f.departure_airport_sk = s.departure_airport_sk AND f.departure_date = s.departure_date))
"""

FACT_COLS = ("passenger_sk, departure_airport_sk, arrival_airport_sk, pilot_sk, ticket_sk, pass_status_sk, "
             "passenger_id, flight_status, original_departure_date, current_departure_date, update_count, "
             "last_record_update")


@query("fact_merge", f"WITH {STAR_CTE} SELECT {FACT_COLS} FROM fact")
def q_fact_merge(spark, sf_dir):
    return run_star(spark, sf_dir)["fact_flight_data"]


def _delayed(state, literal):
    fact = state["fact_flight_data"]
    if literal:
        joins = [ReportJoin(state["dim_airport"], "airport_sk", "arrival_airport_sk",
                            {"airport_name": "arrival_airport_name", "region_name": "country_name"}),
                 ReportJoin(state["dim_arrival_airport"], "arrival_airport_sk", "departure_airport_sk",
                            {"airport_code": "departure_airport"})]
    else:
        joins = [ReportJoin(state["dim_airport"], "airport_sk", "departure_airport_sk",
                            {"airport_name": "departure_airport", "region_name": "region_name"}),
                 ReportJoin(state["dim_arrival_airport"], "arrival_airport_sk", "arrival_airport_sk",
                            {"airport_code": "arrival_airport"})]
    return status_report(fact, "P", joins,
                         fact_cols=("ticket_sk", "original_departure_date", "current_departure_date"))


@query("delayed_orders", f"""WITH {STAR_CTE}
SELECT da.airport_name AS departure_airport, da.region_name AS region_name, aa.airport_code AS arrival_airport,
       f.ticket_sk, f.original_departure_date, f.current_departure_date
FROM fact f LEFT JOIN dim_airport da ON f.departure_airport_sk = da.airport_sk
LEFT JOIN dim_arrival_airport aa ON f.arrival_airport_sk = aa.arrival_airport_sk
WHERE f.flight_status = 'P'""")
def q_delayed_orders(spark, sf_dir):
    return _delayed(run_star(spark, sf_dir), literal=False)


@query("delayed_orders_literal", f"""WITH {STAR_CTE}
SELECT daa.airport_code AS departure_airport, da.airport_name AS arrival_airport_name,
       da.region_name AS country_name, f.ticket_sk, f.original_departure_date, f.current_departure_date
FROM fact f LEFT JOIN dim_airport da ON f.arrival_airport_sk = da.airport_sk
LEFT JOIN dim_arrival_airport daa ON f.departure_airport_sk = daa.arrival_airport_sk
WHERE f.flight_status = 'P'""")
def q_delayed_orders_literal(spark, sf_dir):
    return _delayed(run_star(spark, sf_dir), literal=True)


@query("star_lookup", f"""WITH {STAR_CTE}
SELECT l_orderkey, l_linenumber, passenger_sk, departure_airport_sk, arrival_airport_sk, pilot_sk, ticket_sk,
       pass_status_sk, departure_date, flight_status, passenger_id FROM looked""")
def q_star_lookup(spark, sf_dir):
    _, looked = run_star(spark, sf_dir, lookups_out=True)
    return looked[0].unionByName(looked[1])


@query("dim_scd2_passenger", f"""WITH {STAR_CTE}
SELECT passenger_sk, passenger_id, passenger_name, account_balance, effective_date, expiry_date, current_flag
FROM dim_passenger""")
def q_dim_passenger(spark, sf_dir):
    return run_star(spark, sf_dir)["dim_passenger"]


@query("dim_scd1_airport", f"WITH {STAR_CTE} SELECT airport_sk, airport_name, region_key, region_name FROM dim_airport")
def q_dim_airport(spark, sf_dir):
    return run_star(spark, sf_dir)["dim_airport"]


@query("role_playing", """
WITH dn AS (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS cust_n_name, cn.r_name AS cust_r_name,
       sn.n_name AS supp_n_name, sn.r_name AS supp_r_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN dn cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN dn sn ON s.s_nationkey = sn.n_nationkey""")
def q_role_playing(spark, sf_dir):
    """One nation dimension playing two roles: the customer's and the supplier's nation (D-7)."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    dim = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    cust, supp = F.broadcast(role_view(dim, "cust_")), F.broadcast(role_view(dim, "supp_"))  # 25 rows
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
            .join(s, li.l_suppkey == s.s_suppkey)
            .join(cust, F.col("c_nationkey") == F.col("cust_n_nationkey"), "left")
            .join(supp, F.col("s_nationkey") == F.col("supp_n_nationkey"), "left"))
    return rows.select("l_orderkey", "l_linenumber", "cust_n_name", "cust_r_name", "supp_n_name", "supp_r_name")


RESCHEDULE_CTE = """
rs AS (SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY batch, passenger_id, departure_airport_sk
       ORDER BY departure_date DESC, flight_status DESC, passenger_sk DESC, departure_airport_sk DESC,
       arrival_airport_sk DESC, pilot_sk DESC, ticket_sk DESC, pass_status_sk DESC) = 1),
r1 AS (SELECT * FROM rs WHERE batch = 1), r2 AS (SELECT * FROM rs WHERE batch = 2),
resched AS (
  SELECT r1.passenger_sk, r1.departure_airport_sk, r1.arrival_airport_sk, r1.pilot_sk, r1.ticket_sk,
         r1.pass_status_sk, r1.passenger_id,
         CASE WHEN r2.passenger_id IS NOT NULL AND r2.departure_date <> r1.departure_date
              THEN r2.flight_status ELSE r1.flight_status END AS flight_status,
         r1.departure_date AS original_departure_date,
         CASE WHEN r2.passenger_id IS NOT NULL AND r2.departure_date <> r1.departure_date
              THEN r2.departure_date ELSE r1.departure_date END AS current_departure_date,
         CAST(CASE WHEN r2.passenger_id IS NOT NULL AND r2.departure_date <> r1.departure_date
              THEN 1 ELSE 0 END AS INTEGER) AS update_count,
         CASE WHEN r2.passenger_id IS NOT NULL AND r2.departure_date <> r1.departure_date
              THEN TIMESTAMP '2024-02-02 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS last_record_update
  FROM r1 LEFT JOIN r2 ON r1.passenger_id = r2.passenger_id AND r1.departure_airport_sk = r2.departure_airport_sk
  UNION ALL
  SELECT r2.passenger_sk, r2.departure_airport_sk, r2.arrival_airport_sk, r2.pilot_sk, r2.ticket_sk,
         r2.pass_status_sk, r2.passenger_id, r2.flight_status, r2.departure_date, r2.departure_date,
         CAST(0 AS INTEGER), TIMESTAMP '2024-02-02 00:00:00'
  FROM r2 WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.passenger_id = r2.passenger_id
                            AND r1.departure_airport_sk = r2.departure_airport_sk))
"""


@query("fact_reschedule", f"WITH {STAR_CTE}, {RESCHEDULE_CTE} SELECT {FACT_COLS} FROM resched")
def q_fact_reschedule(spark, sf_dir):
    return run_star(spark, sf_dir, replace(STAR_CFG, reschedule=True))["fact_flight_data"]


# Batches that meet: the rows of STAR_CTE's ``b`` dealt anew, dimensions that change, facts that are matched by the second batch.
OVERLAP_CTE = STAR_CTE[:STAR_CTE.index("dim_pilot AS")].replace("b AS (", "r AS (", 1) + OVERLAP_SQL + "," + STAR_CTE[STAR_CTE.index("dim_pilot AS"):STAR_CTE.index("dim_passenger AS")] + """
v AS (SELECT passenger_id, passenger_name, account_balance, min(batch) AS fb FROM b GROUP BY passenger_id, passenger_name, account_balance),
dim_passenger AS (SELECT CAST(row_number() OVER (ORDER BY fb, passenger_id) AS BIGINT) AS passenger_sk, passenger_id, passenger_name, account_balance, fb,
  CASE WHEN fb = 1 THEN DATE '2024-02-01' ELSE DATE '2024-02-02' END AS effective_date,
  CASE WHEN fb = 1 AND EXISTS (SELECT 1 FROM v w WHERE w.passenger_id = v.passenger_id AND w.fb = 2) THEN DATE '2024-02-02' END AS expiry_date FROM v),
looked AS (
  SELECT p.passenger_sk, a.airport_sk AS departure_airport_sk, aa.arrival_airport_sk, pi.pilot_sk, t.ticket_sk, ps.pass_status_sk, b.departure_date,
         b.flight_status, b.passenger_id, b.batch
  FROM b JOIN dim_passenger p ON b.passenger_id = p.passenger_id AND b.account_balance = p.account_balance
  JOIN dim_airport a ON b.airport_name = a.airport_name JOIN dim_arrival_airport aa ON b.arrival_airport = aa.airport_code
  JOIN dim_pilot pi ON b.pilot_name = pi.pilot_name JOIN dim_ticket_type t ON b.ticket_type = t.ticket_type
  JOIN dim_passenger_status ps ON b.passenger_status = ps.passenger_status),
""" + STAR_CTE[STAR_CTE.index("src AS (SELECT DISTINCT"):]


@query("fact_merge_overlap", f"WITH {OVERLAP_CTE} SELECT {FACT_COLS} FROM fact")
def q_fact_merge_overlap(spark, sf_dir):
    """The literal merge when the second batch meets the first one's facts: a new status on the same date is ignored, a moved flight
    is a second row, and new facts of a changed customer refer to the new version (Q1, D-5, D-6)."""
    return run_star(spark, sf_dir, batches=overlapping_tables)["fact_flight_data"]


@query("dim_scd2_changed", f"""WITH {OVERLAP_CTE}
SELECT passenger_sk, passenger_id, passenger_name, account_balance, effective_date, expiry_date, expiry_date IS NULL AS current_flag FROM dim_passenger""")
def q_dim_scd2_changed(spark, sf_dir):
    """Customers whose balance changes between the batches have two versions, the first one expired."""
    return run_star(spark, sf_dir, facts=False, batches=overlapping_tables)["dim_passenger"]


@query("dim_scd1_changed", f"WITH {OVERLAP_CTE} SELECT airport_sk, airport_name, region_key, region_name FROM dim_airport")
def q_dim_scd1_changed(spark, sf_dir):
    """A region's new name is written over the old one; airports keep their keys."""
    return run_star(spark, sf_dir, facts=False, batches=overlapping_tables)["dim_airport"]
