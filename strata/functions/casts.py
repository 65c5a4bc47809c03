"""Tolerant casts (P-3, P-4): bad input becomes null, nothing raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts accepted by the tolerant date cast, tried in order.
DEFAULT_DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast_int(c) -> Column:
    """String -> INT; a decimal rounds half away from zero ('12.7' -> 13, '12.4999999' -> 12).

    In plain notation the first fraction digit decides, so the others are left out before
    the one rounding; an exponent form goes by its value.  'abc', '' and out-of-range values become null.
    """
    s = F.trim(_c(c))
    plain = F.regexp_replace(s, r"^([+-]?\d*\.\d)\d+$", "$1")
    return F.round(plain.try_cast("decimal(38,6)"), 0).try_cast("int")


def try_cast_date(c, formats=DEFAULT_DATE_FORMATS) -> Column:
    """String -> DATE trying each layout in turn; unparseable input becomes null."""
    s = F.trim(_c(c))
    return F.coalesce(*[F.try_to_date(s, fmt) for fmt in formats])
