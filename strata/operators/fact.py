"""Fact building (D-5, D-6, J-1): star lookups, distinct source, conditional merge."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import point_in_time_lookup
from .merge import S, T, merge
from .touched import Buckets, merge_touched


@dataclass
class Lookup:
    """One dimension lookup: batch columns -> dimension natural key, returning ``sk``."""
    dim: DataFrame
    on: dict            # batch column -> dimension column
    sk: str             # surrogate key column in the dimension
    alias: str | None = None     # name of the key in the output (default: sk)
    current_only: str | None = None  # SCD2 current-flag column: only current rows match (J-2)
    as_of: str | None = None     # batch date column: the version valid then matches instead (D-6)
    extra: list = field(default_factory=list)  # more dimension columns to carry along


def star_lookup(batch: DataFrame, lookups) -> DataFrame:
    """Left-join the batch to each dimension on natural keys (J-1).

    A value missing from a dimension gives a null key.  Dimensions are written
    tables, so by default the planner's file-size statistics
    (``autoBroadcastJoinThreshold``) and AQE's run-time sizes decide whether a
    dimension is broadcast; a large one (growing with the customers) gets a
    shuffle join.
    """
    out = batch
    for lk in lookups:
        d = lk.dim
        if lk.as_of:
            out = point_in_time_lookup(out, d, lk.on, lk.as_of, {lk.sk: lk.alias or lk.sk} | {c: c for c in lk.extra})
            continue
        if lk.current_only:
            d = d.filter(F.coalesce(F.col(lk.current_only), F.lit(False)))  # J-2: filter first
        d = d.select(*[F.col(dc).alias(bc) for bc, dc in lk.on.items()],
                     F.col(lk.sk).alias(lk.alias or lk.sk), *lk.extra)
        out = out.join(d, list(lk.on.keys()), "left")
    return out


def fact_merge(fact: DataFrame, source: DataFrame, keys: dict, date_col: str, run_ts, *,
               carry, status_col: str = "flight_status", orig: str = "original_departure_date",
               cur: str = "current_departure_date", count_col: str = "update_count",
               ts_col: str = "last_record_update", source_unique: bool = False, touched_only: bool = False,
               buckets: Buckets | None = None) -> DataFrame:
    """Conditional MERGE of a fact source (M-2, D-5).

    keys   {fact column: source column} of the ON clause.
    Matched and ``fact.current <> source.date``: current date and status move,
    the counter goes up by one, the timestamp is refreshed.  Not matched:
    insert with original = current = the source date, counter 0.
    carry  fact columns copied from the source on insert (surrogate keys, ids).
    touched_only, buckets  return the updated and inserted rows only, see :func:`merge_touched`.
    """
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    src = source.select(*[F.col(sc).alias(fc) for fc, sc in keys.items()],
                        *[F.col(c) for c in set(carry + [date_col, status_col]) if c not in keys.values()])
    on = list(keys.keys())
    d = S(date_col) if date_col not in keys.values() else S([k for k, v in keys.items() if v == date_col][0])
    insert = {c: S(c) for c in carry if c in src.columns}
    insert.update({k: S(k) for k in on})
    insert.update({orig: d, cur: d, status_col: S(status_col), count_col: F.lit(0), ts_col: ts})
    branches = {"update": {cur: d, status_col: S(status_col), count_col: T(count_col) + 1, ts_col: ts}, "update_if": T(cur) != d,
                "insert": insert, "source_unique": source_unique}
    return merge_touched(fact, src, on, buckets=buckets, **branches) if touched_only else merge(fact, src, on, **branches)
