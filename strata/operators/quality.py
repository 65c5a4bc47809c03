"""Key checks: merge ambiguity (M-4), primary key (G-5), foreign key (G-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AmbiguousMergeError(ValueError):
    """Two source rows would update one target row."""


def duplicate_keys(df: DataFrame, key, count_col: str = "n") -> DataFrame:
    """Keys occurring more than once, plus null keys (a key may not be null).

    Map-side partial aggregation keeps a hot key cheap to count.
    """
    key = [key] if isinstance(key, str) else list(key)
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_col))
    return g.filter((F.col(count_col) > 1) | any_null)


def ambiguous_matches(target: DataFrame, source: DataFrame, on, count_col: str = "n") -> DataFrame:
    """Source keys that occur more than once *and* match a target row.

    Unmatched duplicates are legal (each is inserted); matched ones would make
    the update nondeterministic.
    """
    on = [on] if isinstance(on, str) else list(on)
    dup = (source.groupBy(*on).agg(F.count(F.lit(1)).alias(count_col))
           .filter(F.col(count_col) > 1))
    tkeys = target.select(*on)
    return dup.join(tkeys.join(dup.select(*on), on, "left_semi").distinct(), on, "left_semi")


def assert_unique(source: DataFrame, on, target: DataFrame | None = None) -> None:
    """Raise :class:`AmbiguousMergeError` before anything is written."""
    bad = (ambiguous_matches(target, source, on) if target is not None
           else duplicate_keys(source.na.drop(subset=[on] if isinstance(on, str) else list(on)), on))
    row = bad.limit(1).collect()
    if row:
        raise AmbiguousMergeError(f"merge source is not unique on {on}: {row[0].asDict()}")


def orphans(fact: DataFrame, dim: DataFrame, fk, pk=None) -> DataFrame:
    """Fact rows whose non-null foreign key has no dimension row."""
    fk = [fk] if isinstance(fk, str) else list(fk)
    pk = fk if pk is None else ([pk] if isinstance(pk, str) else list(pk))
    keys = dim.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)]).distinct()
    nonnull = fact
    for f in fk:
        nonnull = nonnull.filter(F.col(f).isNotNull())
    return nonnull.join(keys, fk, "left_anti")
