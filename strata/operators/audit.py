"""Audit records (G-1, G-2) and the run report text (P-11)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("id bigint, proc_name string, affected_rows bigint, status string, "
                "error_message string, run_by string, run_time timestamp_ntz, message string")


def _lit_ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")


def audit_success(counts: DataFrame, proc_name: str, run_by: str, run_ts, audit_id: int = 1,
                  affected_col: str = "affected") -> DataFrame:
    """One SUCCESS row from a one-row counts DataFrame (e.g. :func:`merge_counts`)."""
    n = F.col(affected_col).cast("bigint")
    return counts.select(
        F.lit(audit_id).cast("bigint").alias("id"), F.lit(proc_name).alias("proc_name"),
        n.alias("affected_rows"), F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("error_message"), F.lit(run_by).alias("run_by"),
        _lit_ts(run_ts).alias("run_time"),
        F.concat(F.lit("SUCCESS | Rows merged: "), n.cast("string")).alias("message"))


def audit_failure(spark: SparkSession, proc_name: str, run_by: str, run_ts, error: str,
                  audit_id: int = 1) -> DataFrame:
    """One FAILED row: affected 0, the error text."""
    row = spark.createDataFrame([(audit_id, proc_name, 0, "FAILED", error, run_by)],
                                "id bigint, proc_name string, affected_rows bigint, status string, "
                                "error_message string, run_by string")
    return row.select("*", _lit_ts(run_ts).alias("run_time"),
                      F.concat(F.lit("FAILED | Error: "), F.col("error_message")).alias("message"))


@contextmanager
def audited(spark: SparkSession, sink, proc_name: str, run_by: str, run_ts, audit_id: int = 1):
    """Run a batch; on an exception write a FAILED audit row via ``sink(df)``,
    then re-raise (the failure is never swallowed)."""
    try:
        yield
    except Exception as e:  # noqa: BLE001 - recorded, then re-raised
        sink(audit_failure(spark, proc_name, run_by, run_ts, f"{type(e).__name__}: {e}", audit_id))
        raise
