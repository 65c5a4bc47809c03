"""Silver-layer queries: latest row per key, upserts, merge counts and key checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import try_cast_date, try_cast_int
from ..functions.rows import row_changed
from ..operators.access import grants_frame, layer_access, row_access
from ..operators.audit import audit_success
from ..operators.latest import latest_per_key
from ..operators.merge import merge, merge_counts, observed_counts
from ..operators.quality import ambiguous_matches, duplicate_keys, orphans
from ..operators.touched import merge_touched
from ..session import scratch_path
from ..sources.tables import write_table
from .registry import ORACLES, query
from .testdata import EVENTS_SPLIT, RUN_BY, table, ts

EV_COLS = ["user_id", "event_id", "ts", "event_type", "value"]


def events(spark, sf_dir, null_keys=False):
    e = table(spark, sf_dir, "events").select(*EV_COLS)
    if null_keys:  # inject null keys (every row is kept)
        e = e.withColumn("user_id", F.when(F.col("event_id") % 50 == 0, F.lit(None)).otherwise(F.col("user_id")))
    return e


def event_batches(spark, sf_dir, null_keys=False):
    e = events(spark, sf_dir, null_keys)
    split = F.lit(EVENTS_SPLIT).cast("timestamp_ntz")
    return e.filter(F.col("ts") < split), e.filter(F.col("ts") >= split)


def silver_upserts(spark, sf_dir, null_keys=False):
    """Two silver loads: latest per user of each batch MERGEd into the silver table."""
    b1, b2 = event_batches(spark, sf_dir, null_keys)
    target = spark.createDataFrame([], "user_id bigint, event_id bigint, ts timestamp_ntz, event_type string, "
                                       "value double, _last_updated timestamp_ntz")
    merged = []
    for i, b in enumerate((b1, b2)):
        src = latest_per_key(b, "user_id", "ts", ["event_id"])
        m = merge(target, src, "user_id", set_on_update={"_last_updated": ts(i)},
                  set_on_insert={"_last_updated": ts(i)}).checkpoint(eager=True)
        merged.append(m)
        target = m.drop("_op")
    return target, merged


LATEST_SQL = """SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("latest_per_key", LATEST_SQL)
def q_latest(spark, sf_dir):
    return latest_per_key(events(spark, sf_dir), "user_id", "ts", ["event_id"])


def _upsert_sql(null_keys: bool) -> str:
    uid = "CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END" if null_keys else "user_id"
    return f"""
WITH e AS (SELECT {uid} AS user_id, event_id, ts, event_type, value FROM events),
s1 AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
s2 AS (SELECT * FROM e WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, ts, event_type, value, TIMESTAMP '2024-02-02 00:00:00' AS _last_updated FROM s2
UNION ALL
SELECT user_id, event_id, ts, event_type, value, TIMESTAMP '2024-02-01 00:00:00' AS _last_updated FROM s1
WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s2.user_id = s1.user_id)"""


@query("upsert_latest", _upsert_sql(False))
def q_upsert_latest(spark, sf_dir):
    return silver_upserts(spark, sf_dir)[0]


@query("upsert_null_keys", _upsert_sql(True))
def q_upsert_null_keys(spark, sf_dir):
    """A null key never matches: each batch inserts its null-key row again (literal, Q3)."""
    return silver_upserts(spark, sf_dir, null_keys=True)[0]


@query("merge_counts", """
WITH s1 AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
s2 AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00')
SELECT 1 AS batch, (SELECT count(*) FROM s1) AS inserted, CAST(0 AS BIGINT) AS updated,
       (SELECT count(*) FROM s1) AS affected
UNION ALL
SELECT 2, (SELECT count(*) FROM s2 WHERE user_id NOT IN (SELECT user_id FROM s1)),
       (SELECT count(*) FROM s2 WHERE user_id IN (SELECT user_id FROM s1)), (SELECT count(*) FROM s2)""")
def q_merge_counts(spark, sf_dir):
    _, merged = silver_upserts(spark, sf_dir)
    c1, c2 = (merge_counts(m).select(F.lit(i + 1).alias("batch"), "*") for i, m in enumerate(merged))
    return c1.unionByName(c2)


@query("merge_counts_observed", ORACLES["merge_counts"])
def q_merge_counts_observed(spark, sf_dir):
    """The same counts as the writes of the two loads saw them pass by: nothing is read again."""
    root, target, found = scratch_path(spark, "observed"), None, []
    for i, b in enumerate(event_batches(spark, sf_dir)):
        src = write_table(latest_per_key(b, "user_id", "ts", ["event_id"]), f"{root}/batch{i}")
        if target is None:
            target = src.limit(0).withColumn("_last_updated", ts(i))
        rows, seen = observed_counts(merge_touched(target, src, "user_id", source_unique=True, set_on_update={"_last_updated": ts(i)},
                                                   set_on_insert={"_last_updated": ts(i)}))
        target = write_table(rows, f"{root}/silver{i}").drop("_op")
        n = seen.get
        found.append((i + 1, n["INSERT"], n["UPDATE"], n["rows"]))
    return spark.createDataFrame(found, "batch int, inserted bigint, updated bigint, affected bigint")


@query("audit_success", """
SELECT CAST(1 AS BIGINT) AS id, 'load_silver' AS proc_name, count(DISTINCT user_id) AS affected_rows,
       'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message, 'etl_user' AS run_by,
       TIMESTAMP '2024-02-02 00:00:00' AS run_time,
       'SUCCESS | Rows merged: ' || CAST(count(DISTINCT user_id) AS VARCHAR) AS message
FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""")
def q_audit_success(spark, sf_dir):
    """Audit row of the second silver load: affected rows from the merge itself (W-5, G-1)."""
    _, merged = silver_upserts(spark, sf_dir)
    return audit_success(merge_counts(merged[1]), "load_silver", RUN_BY, ts(1))


def _li(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query("merge_ambiguous", """
WITH t AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'),
s AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT s.l_orderkey, s.l_linenumber, s.n FROM s
WHERE EXISTS (SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)""")
def q_merge_ambiguous(spark, sf_dir):
    """Source keys that would update one target row twice (M-4): what the merge refuses."""
    li = _li(spark, sf_dir)
    split = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    target = li.filter(F.col("l_shipdate") < split).select("l_orderkey", "l_linenumber").distinct()
    source = li.filter(F.col("l_shipdate") >= split)
    return ambiguous_matches(target, source, ["l_orderkey", "l_linenumber"])


@query("pk_check", """
WITH k AS (SELECT l_orderkey, CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber
           FROM lineitem)
SELECT l_orderkey, l_linenumber, count(*) AS n FROM k GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def q_pk_check(spark, sf_dir):
    li = _li(spark, sf_dir).select(
        "l_orderkey",
        F.when(F.col("l_orderkey") % 997 == 0, F.lit(None)).otherwise(F.col("l_linenumber")).alias("l_linenumber"))
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@query("fk_check", """
WITH f AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN l_suppkey + 1000000
                  ELSE l_suppkey END AS l_suppkey FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey FROM f
WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""")
def q_fk_check(spark, sf_dir):
    li = _li(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 103 == 0, F.lit(None))
         .when(F.col("l_orderkey") % 101 == 0, F.col("l_suppkey") + 1000000)
         .otherwise(F.col("l_suppkey")).alias("l_suppkey"))
    sup = table(spark, sf_dir, "supplier")
    return orphans(li, sup, "l_suppkey", "s_suppkey")


ACCESS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


@query("row_access", ACCESS_SQL)
def q_row_access(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return row_access(o, "DATA_ANALYST")


@query("row_access_denied", ACCESS_SQL + " WHERE FALSE")
def q_row_access_denied(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return row_access(o, "PUBLIC")


@query("layer_access", ACCESS_SQL + " UNION ALL " + ACCESS_SQL + " WHERE FALSE")
def q_layer_access(spark, sf_dir):
    """Layer grants (G-8) then the row policy (G-7): AIRLINE_ROLE may read the gold
    layer and passes the policy; DATA_ANALYST has no grant on bronze."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    g = grants_frame(spark)
    seen = row_access(layer_access(o, "AIRLINE_ROLE", "gold", g), "AIRLINE_ROLE")
    denied = row_access(layer_access(o, "DATA_ANALYST", "bronze", g), "DATA_ANALYST")
    return seen.unionByName(denied)


INT_SRC = """CASE c_custkey % 6 WHEN 0 THEN CAST(c_custkey AS VARCHAR)
  WHEN 1 THEN CAST(c_custkey AS VARCHAR) || '.7' WHEN 2 THEN '-' || CAST(c_custkey AS VARCHAR) || '.5'
  WHEN 3 THEN 'x' || CAST(c_custkey AS VARCHAR) WHEN 4 THEN '' ELSE '99999999999' END"""


@query("try_cast_int", f"SELECT c_custkey, s, TRY_CAST(s AS INTEGER) AS age FROM (SELECT c_custkey, {INT_SRC} AS s FROM customer)")
def q_try_cast_int(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    s = (F.when(F.col("c_custkey") % 6 == 0, k).when(F.col("c_custkey") % 6 == 1, F.concat(k, F.lit(".7")))
         .when(F.col("c_custkey") % 6 == 2, F.concat(F.lit("-"), k, F.lit(".5")))
         .when(F.col("c_custkey") % 6 == 3, F.concat(F.lit("x"), k))
         .when(F.col("c_custkey") % 6 == 4, F.lit("")).otherwise(F.lit("99999999999")))
    return c.select("c_custkey", s.alias("s")).select("c_custkey", "s", try_cast_int("s").alias("age"))


DATE_SRC = """CASE o_orderkey % 5
  WHEN 0 THEN CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
  WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0')
  WHEN 2 THEN '13/' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
  WHEN 3 THEN 'n/a'
  ELSE lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '/' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') || '/' || CAST(year(o_orderdate) AS VARCHAR) END"""


@query("try_cast_date", f"""SELECT o_orderkey, s,
  CAST(COALESCE(TRY_STRPTIME(s, '%m/%d/%Y'), TRY_STRPTIME(s, '%Y-%m-%d')) AS DATE) AS departure_date
FROM (SELECT o_orderkey, {DATE_SRC} AS s FROM orders)""")
def q_try_cast_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    m, dd, y = (F.month(d).cast("string"), F.dayofmonth(d).cast("string"), F.year(d).cast("string"))
    k = F.col("o_orderkey") % 5
    s = (F.when(k == 0, F.concat_ws("/", m, dd, y))
         .when(k == 1, F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(dd, 2, "0")))
         .when(k == 2, F.concat_ws("/", F.lit("13"), dd, y))
         .when(k == 3, F.lit("n/a"))
         .otherwise(F.concat_ws("/", F.lpad(m, 2, "0"), F.lpad(dd, 2, "0"), y)))
    return o.select("o_orderkey", s.alias("s")).select("o_orderkey", "s", try_cast_date("s").alias("departure_date"))


@query("row_changed", """
WITH x AS (SELECT c_custkey, c_name AS a1, c_mktsegment AS a2, c_nationkey AS a3,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN c_mktsegment
       WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS b1,
  CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment WHEN c_custkey % 11 = 0 THEN c_name
       WHEN c_custkey % 13 = 0 THEN c_name ELSE c_mktsegment END AS b2,
  c_nationkey AS b3 FROM customer)
SELECT c_custkey, (a1 IS DISTINCT FROM b1 OR a2 IS DISTINCT FROM b2 OR a3 IS DISTINCT FROM b3) AS changed FROM x""")
def q_row_changed(spark, sf_dir):
    """Null-safe change test (P-5): a value moving next to a null is a change."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    b1 = (F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.col("c_mktsegment"))
          .when(k % 13 == 0, F.lit(None)).otherwise(F.col("c_name")))
    b2 = (F.when(k % 7 == 0, F.col("c_mktsegment")).when(k % 11 == 0, F.col("c_name"))
          .when(k % 13 == 0, F.col("c_name")).otherwise(F.col("c_mktsegment")))
    x = c.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", b1.alias("b1"), b2.alias("b2"),
                 F.col("c_nationkey").alias("b3"))
    return x.select("c_custkey", row_changed(["c_name", "c_mktsegment", "c_nationkey"], ["b1", "b2", "b3"])
                    .alias("changed"))
