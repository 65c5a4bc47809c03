"""Latest row per key (W-1).

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC) = 1`` with a
mandatory tie-break so the choice is the same on every run.  Catalyst plans a
partial ``WindowGroupLimit`` before the shuffle, so a hot key sends at most one
row per input partition across the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(order_by, tie_break, descending):
    cols = []
    for c in list(order_by) + list(tie_break):
        c = F.col(c) if isinstance(c, str) else c
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return cols


def latest_per_key(df: DataFrame, key, order_by, tie_break=(), descending: bool = True,
                   n: int = 1) -> DataFrame:
    """Keep the first ``n`` rows of each key by ``order_by`` then ``tie_break``.

    Null keys form one group, as in SQL ``PARTITION BY``.
    """
    key = [key] if isinstance(key, str) else list(key)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    if not tie_break:
        raise ValueError("latest_per_key needs tie-break columns for a total order")
    w = Window.partitionBy(*key).orderBy(*_order(order_by, tie_break, descending))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") <= n).drop("__rn"))
