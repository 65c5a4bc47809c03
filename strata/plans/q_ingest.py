"""Raw-file ingest queries (A-1 ... A-6, A-10) on CSV files Spark writes from ``customer``.

Each file holds one nation's customers and starts with a header line.  Defects
are injected by key (every row is written; none is dropped):
  key % 97 == 0  one field too many          key % 89 == 0  one field too few
  key % 83 == 0  segment over its width      key % 79 == 0  segment 'NULL'
  key % 73 == 0  segment ''                  key % 71 == 0  segment padded with spaces
  key % 67 == 0  name with a comma and doubled quotes
  key % 61 == 0  name with a line break inside quotes
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.csv import FILE, classify, good_rows, load_report, read_raw, reject_rows, stamp
from .registry import query
from .testdata import RUN_TS, table

COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
# Declared widths of the bronze columns (VARCHAR(n)).
WIDTHS = {"c_name": 25, "c_mktsegment": 10}
HEADER = ",".join(COLUMNS)


def csv_lines(spark, sf_dir):
    """One CSV line per customer (with the injected defects) plus its file number."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bad_count = (k % 97 == 0) | (k % 89 == 0)
    name = (F.when(bad_count, F.col("c_name"))
            .when(k % 67 == 0, F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""Jr""'), F.lit('"')))
            .when(k % 61 == 0, F.concat(F.lit('"'), F.col("c_name"), F.lit("\nline2"), F.lit('"')))
            .otherwise(F.col("c_name")))
    seg = (F.when(k % 83 == 0, F.concat(F.col("c_mktsegment"), F.lit("_EXTRA")))
           .when(k % 79 == 0, F.lit("NULL")).when(k % 73 == 0, F.lit(""))
           .when(k % 71 == 0, F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("  ")))
           .otherwise(F.col("c_mktsegment")))
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    base = [k.cast("string"), name, F.col("c_nationkey").cast("string"), cents]
    line = (F.when(k % 97 == 0, F.concat_ws(",", *base, seg, F.lit("extra")))
            .when(k % 89 == 0, F.concat_ws(",", *base))
            .otherwise(F.concat_ws(",", *base, seg)))
    return c.select(F.col("c_nationkey").alias("file_no"), k.alias("ord"), line.alias("value"))


def write_csv_files(spark, sf_dir, path, file_filter=None):
    """Write the lines as text files, one directory per nation, header first in each file."""
    lines = csv_lines(spark, sf_dir)
    if file_filter is not None:
        lines = lines.filter(file_filter)
    heads = lines.select("file_no").distinct().select("file_no", F.lit(-1).cast("bigint").alias("ord"),
                                                       F.lit(HEADER).alias("value"))
    (lines.unionByName(heads).repartition("file_no").sortWithinPartitions("file_no", "ord").drop("ord")
     .write.mode("append").partitionBy("file_no").text(path))
    return path


def landed(spark, sf_dir):
    path = write_csv_files(spark, sf_dir, scratch_path(spark, "landing"))
    raw = read_raw(spark, path, COLUMNS)
    return classify(raw, WIDTHS)


LINE_SQL = """
WITH c AS (SELECT c_custkey AS k, * FROM customer),
f AS (SELECT k, c_nationkey,
  CASE WHEN k % 97 = 0 OR k % 89 = 0 THEN c_name WHEN k % 67 = 0 THEN c_name || ', "Jr"'
       WHEN k % 61 = 0 THEN c_name || chr(10) || 'line2' ELSE c_name END AS name_parsed,
  CASE WHEN k % 97 = 0 OR k % 89 = 0 THEN c_name WHEN k % 67 = 0 THEN '"' || c_name || ', ""Jr""' || '"'
       WHEN k % 61 = 0 THEN '"' || c_name || chr(10) || 'line2"' ELSE c_name END AS name_raw,
  CASE WHEN k % 83 = 0 THEN c_mktsegment || '_EXTRA' WHEN k % 79 = 0 THEN 'NULL' WHEN k % 73 = 0 THEN ''
       WHEN k % 71 = 0 THEN '  ' || c_mktsegment || '  ' ELSE c_mktsegment END AS seg_raw,
  CASE WHEN k % 83 = 0 THEN c_mktsegment || '_EXTRA' WHEN k % 79 = 0 THEN NULL WHEN k % 73 = 0 THEN NULL
       ELSE c_mktsegment END AS seg_clean,
  CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS cents FROM c),
r AS (SELECT *,
  CASE WHEN k % 97 = 0 THEN CAST(k AS VARCHAR) || ',' || name_raw || ',' || CAST(c_nationkey AS VARCHAR) || ',' || cents || ',' || seg_raw || ',extra'
       WHEN k % 89 = 0 THEN CAST(k AS VARCHAR) || ',' || name_raw || ',' || CAST(c_nationkey AS VARCHAR) || ',' || cents
  END AS raw,
  CASE WHEN k % 97 = 0 OR k % 89 = 0 THEN 'column_count'
       WHEN length(name_parsed) > 25 THEN 'width:c_name'
       WHEN length(seg_clean) > 10 THEN 'width:c_mktsegment' END AS reason FROM f)
"""


@query("ingest_csv", LINE_SQL + """
SELECT CAST(k AS VARCHAR) AS c_custkey, name_parsed AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       cents AS c_acctbal, seg_clean AS c_mktsegment, TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at
FROM r WHERE reason IS NULL""")
def q_ingest_csv(spark, sf_dir):
    """Bronze rows: positional, trimmed, nulls applied, rejects set aside, stamped (A-1 ... A-6)."""
    return stamp(good_rows(landed(spark, sf_dir)).drop(FILE), RUN_TS[0])


@query("null_markers", LINE_SQL + "SELECT CAST(k AS VARCHAR) AS c_custkey, seg_clean AS c_mktsegment FROM r WHERE reason IS NULL")
def q_null_markers(spark, sf_dir):
    return good_rows(landed(spark, sf_dir)).select("c_custkey", "c_mktsegment")


@query("reject_rows", LINE_SQL + """
SELECT CAST(k AS VARCHAR) AS c_custkey, raw AS _corrupt_record, reason AS _reject_reason FROM r WHERE reason IS NOT NULL""")
def q_reject_rows(spark, sf_dir):
    """Rows set aside, with the raw text of a malformed row and the reason (A-4, A-5)."""
    return reject_rows(landed(spark, sf_dir)).select("c_custkey", "_corrupt_record", "_reject_reason")


@query("width_check", LINE_SQL + """
SELECT CAST(k AS VARCHAR) AS c_custkey, reason AS _reject_reason FROM r WHERE reason LIKE 'width:%'""")
def q_width_check(spark, sf_dir):
    rej = reject_rows(landed(spark, sf_dir))
    return rej.filter(F.col("_reject_reason").startswith("width:")).select("c_custkey", "_reject_reason")


@query("load_report", LINE_SQL + """
SELECT CAST(c_nationkey AS INTEGER) AS file_no, count(*) AS rows_read, count(*) FILTER (WHERE reason IS NULL) AS rows_loaded,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rows_rejected, min(raw) AS first_error
FROM r GROUP BY c_nationkey""")
def q_load_report(spark, sf_dir):
    """Per-file load report; the file is named by its directory (A-10)."""
    rep = load_report(landed(spark, sf_dir))
    return rep.select(F.regexp_extract(FILE, r"file_no=(\d+)", 1).cast("int").alias("file_no"),
                      "rows_read", "rows_loaded", "rows_rejected", "first_error")
