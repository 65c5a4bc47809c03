"""Restores from an older version (T-3, T-4) as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .merge import S, merge


def restore_rows(current: DataFrame, old: DataFrame, key, literal: bool = False) -> DataFrame:
    """Rows to INSERT to bring back deleted rows.

    literal=False: only rows of ``old`` missing from ``current`` (by key).
    literal=True:  every row of ``old`` (the plain INSERT ... SELECT ... AT: survivors double).
    """
    key = [key] if isinstance(key, str) else list(key)
    return old if literal else old.join(current.select(*key), key, "left_anti")


def restore_column(current: DataFrame, old: DataFrame, key, column) -> DataFrame:
    """UPDATE current SET column = old.column FROM old WHERE key match (J-4, J-7).

    Returns the merged rows with ``_op``; ``old`` must be unique on ``key``
    (checked: two old rows for one current row raise).
    """
    cols = [column] if isinstance(column, str) else list(column)
    key = [key] if isinstance(key, str) else list(key)
    return merge(current, old.select(*key, *cols), key, update={c: S(c) for c in cols}, insert=None)
