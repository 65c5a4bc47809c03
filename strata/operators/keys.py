"""Surrogate keys (D-4): 1, 2, 3, ... after the current maximum, in a fixed order.

No single-partition window over the rows: the new rows are range-partitioned
on the order columns and sorted within partitions; the per-partition row index
comes from ``monotonically_increasing_id`` and the partition offsets from a
tiny per-partition count table (one row per partition: a proven size bound,
safe to broadcast).  The ranged rows are written to the shared folder, once and compressed, so
the numbering is fixed before anyone reads it, and a lost executor cannot
renumber them; the counts read one column of that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import write_table

_LOW = (1 << 33) - 1


def max_key(df: DataFrame, sk_col: str) -> int:
    """Current maximum surrogate key, 0 for an empty table (a scalar through the driver)."""
    v = df.agg(F.max(sk_col)).first()[0]
    return int(v or 0)


def _order_cols(order_by):
    out = []
    for c in ([order_by] if isinstance(order_by, str) else order_by):
        out.append(F.col(c).asc_nulls_last() if isinstance(c, str) else c)
    return out


def assign_keys(rows: DataFrame, sk_col: str, order_by, start: int = 0,
                num_partitions: int | None = None, key_type: str = "bigint") -> DataFrame:
    """Number ``rows`` start+1, start+2, ... in ``order_by`` order, which should be unique on ``rows``."""
    order = _order_cols(order_by)
    spark = rows.sparkSession
    # without a given number AQE joins neighbouring small ranges, which keeps the order and saves a task and a file for each
    ranged = rows.repartitionByRange(num_partitions, *order) if num_partitions else rows.repartitionByRange(*order)
    ranged = (ranged.sortWithinPartitions(*order)
              .withColumn("__mid", F.monotonically_increasing_id()))
    fixed = write_table(ranged, scratch_path(spark, "keys"))
    pid = F.shiftright(F.col("__mid"), 33)
    counts = fixed.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    keyed = (fixed.withColumn("__pid", pid)
             .join(F.broadcast(offsets), "__pid")
             .withColumn(sk_col, (F.lit(start) + F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_LOW)) + 1)
                         .cast(key_type)))
    return keyed.drop("__pid", "__off", "__mid")
