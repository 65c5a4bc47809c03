"""MERGE of a batch into a bucketed table: only the rows that the batch touches (M-1, M-2, J-5)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators.fact import fact_merge
from ..operators.merge import S, T
from ..operators.touched import Buckets, merge_touched
from ..session import scratch_path
from ..sources.tables import write_table
from .gold import FACT_SKS, fact_keys
from .q_star import FACT_COLS, RESCHEDULE_CTE, STAR_CTE, run_star
from .registry import query
from .testdata import ORDERS_SPLIT, STAR_CFG, table, ts


def shipped(spark, sf_dir):
    """Per order and batch (shipped before the split date or not): lines and quantity."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    split = F.lit(ORDERS_SPLIT).cast("timestamp_ntz")
    sums = [F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"), F.max("l_shipdate").alias("last_ship")]
    return [li.filter(c).groupBy("l_orderkey").agg(*sums) for c in (F.col("l_shipdate") < split, F.col("l_shipdate") >= split)]


@query("merge_touched", """
WITH b AS (SELECT l_orderkey, l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AS late, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
             max(l_shipdate) AS last_ship FROM lineitem GROUP BY ALL),
t AS (SELECT * FROM b WHERE NOT late), s AS (SELECT * FROM b WHERE late)
SELECT s.l_orderkey, s.n_lines + coalesce(t.n_lines, 0) AS n_lines, s.quantity + coalesce(t.quantity, 0) AS quantity, s.last_ship,
       CAST(CASE WHEN t.l_orderkey IS NULL THEN 0 ELSE 1 END AS INTEGER) AS update_count, CASE WHEN t.l_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS _op
FROM s LEFT JOIN t ON s.l_orderkey = t.l_orderkey""")
def q_merge_touched(spark, sf_dir):
    """Late shipments are added to their orders' running totals: the result is what such a batch writes."""
    root, buckets = scratch_path(spark, "touched"), Buckets(("l_orderkey",), 16)
    first, second = shipped(spark, sf_dir)
    target = buckets.write(first.withColumn("update_count", F.lit(0)), f"{root}/target")
    batch = write_table(second, f"{root}/batch")
    out = merge_touched(target, batch, "l_orderkey", buckets=buckets, source_unique=True,
                        update={"n_lines": T("n_lines") + S("n_lines"), "quantity": T("quantity") + S("quantity"), "last_ship": S("last_ship"),
                                "update_count": T("update_count") + 1}, set_on_insert={"update_count": F.lit(0)})
    return out.drop("_bucket")


def touched_fact(spark, sf_dir, cfg):
    """The second gold batch as a merge into the first one's fact table in buckets."""
    root, buckets = scratch_path(spark, "touched-fact"), Buckets((cfg.passenger_key,), 16)
    state, looked = run_star(spark, sf_dir, cfg, lookups_out=True, facts=False)
    facts = None
    for i, rows in enumerate(looked):
        src, keys, unique = fact_keys(rows.drop("l_orderkey", "l_linenumber").distinct(), cfg)
        src = write_table(src, f"{root}/batch{i + 1}")
        if facts is None:
            facts = buckets.write(state["fact_flight_data"], f"{root}/empty")
        out = fact_merge(facts, src, keys, cfg.date_col, ts(i), carry=FACT_SKS + [cfg.passenger_key], status_col=cfg.flight_status, source_unique=unique,
                         touched_only=True, buckets=buckets)
        if i == 0:
            facts = buckets.write(out.drop("_op", "_bucket"), f"{root}/fact")
    return out.drop("_bucket")


@query("fact_touched", f"""WITH {STAR_CTE}, {RESCHEDULE_CTE}
SELECT {FACT_COLS}, CASE WHEN update_count = 1 THEN 'UPDATE' ELSE 'INSERT' END AS _op FROM resched
WHERE last_record_update = TIMESTAMP '2024-02-02 00:00:00'""")
def q_fact_touched(spark, sf_dir):
    """Rescheduled and new flights of the second batch, and no others (M-2 with a live update branch)."""
    return touched_fact(spark, sf_dir, replace(STAR_CFG, reschedule=True))


@query("fact_touched_literal", f"""WITH {STAR_CTE}
SELECT {FACT_COLS}, 'INSERT' AS _op FROM fact WHERE last_record_update = TIMESTAMP '2024-02-02 00:00:00'""")
def q_fact_touched_literal(spark, sf_dir):
    """The literal keys, whose source has several rows a key: all that comes out is new."""
    return touched_fact(spark, sf_dir, STAR_CFG)
