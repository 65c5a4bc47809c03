"""Null-safe row comparison (P-5).

A value moving into the neighbouring column next to a null is a change; a
hash that skips nulls would miss it, a null-safe struct comparison does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _struct(cols) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c) for c in cols])


def rows_equal(left_cols, right_cols) -> Column:
    """True when the two column lists are equal position by position, nulls equal."""
    return _struct(left_cols).eqNullSafe(_struct(right_cols))


def row_changed(left_cols, right_cols) -> Column:
    """Negation of :func:`rows_equal`; never null."""
    return ~rows_equal(left_cols, right_cols)
