"""Change-feed queries on per-user snapshots of ``events`` (B-1 ... B-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cdc import VERSION, after_images, diff_snapshots, has_changes, net_changes
from ..operators.digests import diff_digested, write_digested
from ..operators.latest import latest_per_key
from ..operators.touched import Buckets
from ..session import scratch_path
from .q_silver import events
from .registry import query
from .testdata import EVENTS_SNAPSHOTS, table

COLS = ["user_id", "event_id", "ts", "event_type", "value"]


def snapshot(spark, sf_dir, i):
    """Latest event per user before the i-th cut-off (version i+1 of the user table)."""
    e = events(spark, sf_dir).filter(F.col("ts") < F.lit(EVENTS_SNAPSHOTS[i]).cast("timestamp_ntz"))
    return latest_per_key(e, "user_id", "ts", ["event_id"]).select(*COLS)


def _snap_sql(i):
    return (f"(SELECT {', '.join(COLS)} FROM events WHERE ts < TIMESTAMP '{EVENTS_SNAPSHOTS[i]}' "
            "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)")


def diff_sql(a, b, actions=("DELETE", "INSERT")):
    vals = [c for c in COLS if c != "user_id"]
    dist = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in vals)
    parts = []
    if "DELETE" in actions:
        parts.append(f"SELECT {', '.join('o.' + c for c in COLS)}, 'DELETE' AS _action, "
                     f"(n.user_id IS NOT NULL) AS _is_update FROM {_snap_sql(a)} o LEFT JOIN {_snap_sql(b)} n "
                     f"ON o.user_id = n.user_id WHERE n.user_id IS NULL OR {dist}")
    if "INSERT" in actions:
        parts.append(f"SELECT {', '.join('n.' + c for c in COLS)}, 'INSERT' AS _action, "
                     f"(o.user_id IS NOT NULL) AS _is_update FROM {_snap_sql(b)} n LEFT JOIN {_snap_sql(a)} o "
                     f"ON o.user_id = n.user_id WHERE o.user_id IS NULL OR {dist}")
    return " UNION ALL ".join(parts)


@query("cdc_diff", diff_sql(0, 1))
def q_cdc_diff(spark, sf_dir):
    return diff_snapshots(snapshot(spark, sf_dir, 0), snapshot(spark, sf_dir, 1), "user_id")


def digested(spark, frames, key, n):
    root = scratch_path(spark, "digested")
    return [write_digested(df, f"{root}/{i}", Buckets((key,), n)) for i, df in enumerate(frames)]


@query("cdc_diff_digest", diff_sql(0, 1))
def q_cdc_diff_digest(spark, sf_dir):
    """The same diff from the snapshots' digests: rows are read of buckets that differ."""
    return diff_digested(*digested(spark, [snapshot(spark, sf_dir, i) for i in (0, 1)], "user_id", 64), "user_id", COLS)


@query("cdc_diff_digest_few", """
WITH n AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 5000 = 7 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 5000 <> 11)
SELECT o.*, 'DELETE' AS _action, n.o_orderkey IS NOT NULL AS _is_update FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders) o LEFT JOIN n USING (o_orderkey)
WHERE n.o_orderkey IS NULL OR n.o_orderpriority IS DISTINCT FROM o.o_orderpriority
UNION ALL SELECT n.*, 'INSERT', TRUE FROM n JOIN orders o USING (o_orderkey) WHERE n.o_orderpriority IS DISTINCT FROM o.o_orderpriority""")
def q_cdc_diff_digest_few(spark, sf_dir):
    """A few changed and a few deleted rows among all orders: few of the 512 buckets differ."""
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    new = old.filter("o_orderkey % 5000 <> 11").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5000 != 7, F.col("o_orderpriority")))
    return diff_digested(*digested(spark, [old, new], "o_orderkey", 512), "o_orderkey")


def version_log(spark, sf_dir):
    """Change log of the user table: v1 = first snapshot, v2/v3 = diffs to the next ones."""
    s = [snapshot(spark, sf_dir, i) for i in range(3)]
    empty = s[0].limit(0)
    parts = [diff_snapshots(a, b, "user_id").withColumn(VERSION, F.lit(v + 1))
             for v, (a, b) in enumerate(zip([empty] + s[:2], s))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("cdc_net", diff_sql(0, 2))
def q_cdc_net(spark, sf_dir):
    """Net feed over versions 2..3 read from the log equals the direct diff v1 -> v3."""
    return net_changes(version_log(spark, sf_dir), "user_id", from_version=1, to_version=3)


@query("cdc_after_images", f"SELECT {', '.join(COLS)}, _is_update FROM ({diff_sql(1, 2, ('INSERT',))})")
def q_cdc_after_images(spark, sf_dir):
    feed = diff_snapshots(snapshot(spark, sf_dir, 1), snapshot(spark, sf_dir, 2), "user_id")
    return after_images(feed).select(*COLS, "_is_update")


@query("cdc_has_data", f"""
SELECT 1 AS from_version, 2 AS to_version, EXISTS ({diff_sql(0, 1)}) AS has_data
UNION ALL SELECT 2, 3, EXISTS ({diff_sql(1, 2)})
UNION ALL SELECT 3, 3, FALSE""")
def q_cdc_has_data(spark, sf_dir):
    log = version_log(spark, sf_dir)
    out = None
    for a, b in ((1, 2), (2, 3), (3, 3)):
        h = has_changes(net_changes(log, "user_id", a, b)).select(
            F.lit(a).alias("from_version"), F.lit(b).alias("to_version"), "has_data")
        out = h if out is None else out.unionByName(h)
    return out
