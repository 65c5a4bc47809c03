"""Point-in-time lookup (D-6, J-2): the dimension version that was valid when a fact happened.

The current-row lookup of the star load binds a fact to the version that is current when the batch runs.  A late
fact, or a reload of history, belongs to the version that was valid on the fact's own date.  Facts and versions are
united and sorted by date within a key; the last version before a fact is its own if it hadn't expired.  The sort is a
window, so each side is read once and a key with many versions costs no more than its rows.  Windows are cut into
ranges of dates: a key with a large share of the facts is spread over as many tasks as there are ranges, and each
range opens with the version that was valid at its start, which a window over the (few) ranges of a key finds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .merge import _any_null

_RANGE, _AT, _KIND, _VERSION, _ROW = "__range", "__at", "__kind", "__version", "__row"
#: In the order in which rows of one date are seen.
_OPENING, _STARTED, _FACT = 0, 1, 2


def point_in_time_lookup(facts: DataFrame, dim: DataFrame, on: dict, at: str, columns: dict, *, effective: str = "effective_date",
                         expiry: str = "expiry_date", days: int = 28) -> DataFrame:
    """``facts`` with ``columns`` {dimension column: output name} of the version of ``dim`` valid at ``at``.

    on   {fact column: dimension column}, the natural key.
    at   the fact's date or timestamp; versions are half-open, ``effective <= at < expiry``, a null expiry is open.
    days the width of a range.
    A fact before its key's first version, in a gap between two, with an unknown or null key or a null date gets nulls.
    Of several versions that start at one time the one that expires last counts; an empty one (same start and expiry) never does.
    """
    keys = list(on)
    kind = facts.schema[at].dataType
    known = ~(_any_null([*keys, at]))
    carried = F.struct(*[F.col(c) for c in dict.fromkeys([*columns, expiry])])
    versions = dim.filter(~_any_null([*on.values(), effective])).select(
        *[F.col(d).cast(facts.schema[f].dataType).alias(f) for f, d in on.items()], F.col(effective).cast(kind).alias(_AT), carried.alias(_VERSION))
    versions = versions.filter(F.col(f"{_VERSION}.{expiry}").isNull() | (F.col(_AT) < F.col(f"{_VERSION}.{expiry}").cast(kind)))

    def ranged(df: DataFrame) -> DataFrame:
        return df.withColumn(_RANGE, F.floor(F.unix_date(F.col(_AT).cast("date")) / days))

    rows = ranged(facts.filter(known).select(*keys, F.col(at).alias(_AT), F.struct(*facts.columns).alias(_ROW)))
    versions = ranged(versions)
    # the version that each range of a key opens with: one row a range, and the versions
    start = F.date_from_unix_date((F.col(_RANGE) * days).cast("int")).cast(kind)
    cells = rows.select(*keys, _RANGE).distinct().select(*keys, _RANGE, start.alias(_AT), F.lit(_OPENING).alias(_KIND))
    either = cells.unionByName(versions.withColumn(_KIND, F.lit(_STARTED)), allowMissingColumns=True)
    seen = Window.partitionBy(*keys).orderBy(_AT, _KIND, F.col(f"{_VERSION}.{expiry}").asc_nulls_last())
    opening = either.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(seen.rowsBetween(Window.unboundedPreceding, 0)))
    opening = opening.filter((F.col(_KIND) == _OPENING) & F.col(_VERSION).isNotNull())
    every = (opening.unionByName(versions.withColumn(_KIND, F.lit(_STARTED)))
             .unionByName(rows.withColumn(_KIND, F.lit(_FACT)), allowMissingColumns=True))
    seen = Window.partitionBy(*keys, _RANGE).orderBy(_AT, _KIND, F.col(f"{_VERSION}.{expiry}").asc_nulls_last())
    found = every.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(seen.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col(_KIND) == _FACT)
    valid = F.col(f"{_VERSION}.{expiry}").isNull() | (F.col(_AT) < F.col(f"{_VERSION}.{expiry}").cast(kind))
    out = found.select(f"{_ROW}.*", *[F.when(valid, F.col(f"{_VERSION}.{c}")).alias(a) for c, a in columns.items()])
    rest = facts.filter(~known).select(*facts.columns, *[F.lit(None).cast(dim.schema[c].dataType).alias(a) for c, a in columns.items()])
    return out.unionByName(rest)
