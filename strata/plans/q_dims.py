"""Dimension queries on the test tables (D-1 ... D-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dims import lookup_dim, scd1, scd2, scd2_from_history
from ..operators.latest import latest_per_key
from .q_silver import event_batches, events
from .registry import query
from .testdata import EVENTS_SNAPSHOTS, run_date, table


@query("dim_insert_only", """
SELECT CAST(row_number() OVER (ORDER BY fb, p_brand) AS BIGINT) AS brand_sk, p_brand
FROM (SELECT p_brand, min(CASE WHEN p_size <= 25 THEN 1 ELSE 2 END) AS fb FROM part GROUP BY p_brand)""")
def q_dim_insert_only(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    dim = spark.createDataFrame([], "brand_sk bigint, p_brand string")
    for b in (p.filter(F.col("p_size") <= 25), p.filter(F.col("p_size") > 25)):
        dim = lookup_dim(dim, b, "p_brand", "brand_sk").checkpoint(eager=True)
    return dim


@query("surrogate_keys", """
SELECT CAST(row_number() OVER (ORDER BY fb, l_orderkey, l_linenumber) AS BIGINT) AS line_sk, l_orderkey, l_linenumber
FROM (SELECT l_orderkey, l_linenumber,
             min(CASE WHEN l_shipdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END) AS fb
      FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def q_surrogate_keys(spark, sf_dir):
    """Keys for every distinct line key, in two batches, through the distributed
    (range-partitioned) numbering path."""
    li = table(spark, sf_dir, "lineitem")
    split = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    dim = spark.createDataFrame([], "line_sk bigint, l_orderkey bigint, l_linenumber int")
    for b in (li.filter(F.col("l_shipdate") < split), li.filter(F.col("l_shipdate") >= split)):
        dim = lookup_dim(dim, b, ["l_orderkey", "l_linenumber"], "line_sk").checkpoint(eager=True)
    return dim


@query("dim_scd1", """
WITH l AS (SELECT user_id, event_type, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
k AS (SELECT user_id, min(CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END) AS fb
      FROM events GROUP BY user_id)
SELECT CAST(row_number() OVER (ORDER BY k.fb, k.user_id) AS BIGINT) AS user_sk, l.user_id, l.event_type, l.value
FROM l JOIN k ON l.user_id = k.user_id""")
def q_dim_scd1(spark, sf_dir):
    dim = spark.createDataFrame([], "user_sk bigint, user_id bigint, event_type string, value double")
    for b in event_batches(spark, sf_dir):
        last = latest_per_key(b, "user_id", "ts", ["event_id"])
        dim = scd1(dim, last, "user_id", ["event_type", "value"], "user_sk").checkpoint(eager=True)
    return dim


def banded(df):
    return df.withColumn("band", F.floor(F.col("value") / 100).cast("int"))


def scd2_batches(spark, sf_dir):
    e = banded(events(spark, sf_dir))
    cuts = [F.lit(c).cast("timestamp_ntz") for c in EVENTS_SNAPSHOTS[:2]]
    return [e.filter(F.col("ts") < cuts[0]),
            e.filter((F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1])),
            e.filter(F.col("ts") >= cuts[1])]


def scd2_incremental_dim(spark, sf_dir):
    dim = spark.createDataFrame([], "user_sk bigint, user_id bigint, event_type string, band int, "
                                    "effective_date date, expiry_date date, current_flag boolean")
    for i, b in enumerate(scd2_batches(spark, sf_dir)):
        last = latest_per_key(b, "user_id", "ts", ["event_id"])
        dim = scd2(dim, last, "user_id", ["event_type", "band"], run_date(i), "user_sk").checkpoint(eager=True)
    return dim


SCD2_INC_CTE = """
e AS (SELECT user_id, event_id, ts, event_type, CAST(floor(value / 100) AS INTEGER) AS band,
        CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 1 WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 2
             ELSE 3 END AS b FROM events),
l AS (SELECT user_id, b, event_type, band FROM e
      QUALIFY row_number() OVER (PARTITION BY user_id, b ORDER BY ts DESC, event_id DESC) = 1),
c AS (SELECT *, lag(event_type) OVER w AS pt, lag(band) OVER w AS pb, row_number() OVER w AS rn
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY b)),
k AS (SELECT user_id, b, event_type, band,
        CASE b WHEN 1 THEN DATE '2024-02-01' WHEN 2 THEN DATE '2024-02-02' ELSE DATE '2024-02-03' END AS eff
      FROM c WHERE rn = 1 OR pt IS DISTINCT FROM event_type OR pb IS DISTINCT FROM band),
scd AS (SELECT CAST(row_number() OVER (ORDER BY b, user_id) AS BIGINT) AS user_sk, user_id, event_type, band,
        eff AS effective_date, lead(eff) OVER (PARTITION BY user_id ORDER BY b) AS expiry_date,
        lead(eff) OVER (PARTITION BY user_id ORDER BY b) IS NULL AS current_flag FROM k)
"""


@query("scd2_incremental", f"WITH {SCD2_INC_CTE} SELECT * FROM scd")
def q_scd2_incremental(spark, sf_dir):
    return scd2_incremental_dim(spark, sf_dir)


@query("scd2_current_lookup", f"""WITH {SCD2_INC_CTE}
SELECT ev.event_id, ev.user_id, s.user_sk FROM events ev LEFT JOIN scd s ON ev.user_id = s.user_id AND s.current_flag""")
def q_scd2_current_lookup(spark, sf_dir):
    """Every event looks up its user's *current* SCD2 row (J-2: filter, then left join)."""
    dim = scd2_incremental_dim(spark, sf_dir).filter("current_flag").select("user_id", "user_sk")
    return events(spark, sf_dir).select("event_id", "user_id").join(dim, "user_id", "left") \
        .select("event_id", "user_id", "user_sk")


@query("scd2_history", """
WITH e AS (SELECT user_id, event_id, ts, event_type, CAST(floor(value / 100) AS INTEGER) AS band,
             CAST(ts AS DATE) AS d FROM events),
l AS (SELECT user_id, d, event_type, band FROM e
      QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1),
c AS (SELECT *, lag(event_type) OVER w AS pt, lag(band) OVER w AS pb, row_number() OVER w AS rn
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY d)),
k AS (SELECT * FROM c WHERE rn = 1 OR pt IS DISTINCT FROM event_type OR pb IS DISTINCT FROM band)
SELECT user_id, event_type, band, d AS effective_date, lead(d) OVER (PARTITION BY user_id ORDER BY d) AS expiry_date,
       lead(d) OVER (PARTITION BY user_id ORDER BY d) IS NULL AS current_flag FROM k""")
def q_scd2_history(spark, sf_dir):
    e = banded(events(spark, sf_dir))
    return scd2_from_history(e, "user_id", ["event_type", "band"], "ts", ["event_id"]).select(
        "user_id", "event_type", "band", "effective_date", "expiry_date", "current_flag")
