"""Date columns of mixed layouts (P-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import cast_dates, date_evidence
from .registry import query
from .testdata import table

KINDS = ("us", "eu", "mixed")


def dated(spark, sf_dir):
    """The order date as text: month first, day first with dots and some year first, and year first with a few month first; some junk."""
    o, d, k = table(spark, sf_dir, "orders"), F.col("o_orderdate"), F.col("o_orderkey")
    m, dd, y = (f(d).cast("string") for f in (F.month, F.dayofmonth, F.year))
    iso = F.date_format(d, "yyyy-MM-dd")
    us, eu = F.concat_ws("/", m, dd, y), F.concat_ws(".", F.lpad(dd, 2, "0"), F.lpad(m, 2, "0"), y)
    junk = F.when(k % 50 == 0, "n/a").when(k % 50 == 1, " ").when(k % 50 == 2, "31/31/1999")
    return o.select("o_orderkey", F.coalesce(junk, us).alias("us"), F.coalesce(junk, F.when(k % 5 == 0, iso).otherwise(eu)).alias("eu"),
                    F.when(k % 7 != 0, F.coalesce(junk, F.when(k % 9 == 0, us).otherwise(iso))).alias("mixed"))


@query("date_layouts", """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 > 2 THEN CAST(o_orderdate AS DATE) END AS us, CASE WHEN o_orderkey % 50 > 2 THEN CAST(o_orderdate AS DATE) END AS eu,
       CASE WHEN o_orderkey % 50 > 2 AND o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS mixed FROM orders""")
def q_date_layouts(spark, sf_dir):
    """Three columns of one truth in three layouts: read right, every one."""
    return cast_dates(dated(spark, sf_dir), KINDS)


@query("date_evidence", """
WITH o AS (SELECT o_orderkey AS k, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 50 > 2 AS ok, o_orderkey % 50 <> 1 AS filled FROM orders),
v AS (SELECT 'us' AS c, * , 'us' AS l FROM o UNION ALL SELECT 'eu', *, CASE WHEN k % 5 = 0 THEN 'iso' ELSE 'eu' END FROM o
      UNION ALL SELECT 'mixed', *, CASE WHEN k % 9 = 0 THEN 'us' ELSE 'iso' END FROM o WHERE k % 7 <> 0)
SELECT c AS column_name, count(*) FILTER (WHERE filled) AS filled, count(*) FILTER (WHERE ok AND l = 'iso') AS year_first,
       count(*) FILTER (WHERE ok AND (l = 'us' OR l = 'eu' AND d <= 12)) AS month_first, count(*) FILTER (WHERE ok AND (l = 'eu' OR l = 'us' AND d <= 12)) AS day_first,
       count(*) FILTER (WHERE ok AND l = 'eu' AND d > 12 OR k % 50 = 2) AS first_over_12, count(*) FILTER (WHERE ok AND l = 'us' AND d > 12 OR k % 50 = 2) AS second_over_12,
       count(*) FILTER (WHERE k % 50 IN (0, 2)) AS unread, CASE c WHEN 'eu' THEN 'day first' ELSE 'month first' END AS layout
FROM v GROUP BY c""")
def q_date_evidence(spark, sf_dir):
    return date_evidence(dated(spark, sf_dir), KINDS)
