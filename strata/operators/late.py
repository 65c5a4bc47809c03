"""SCD2 from late and out-of-order batches (D-3): intervals are split by what a batch observes and coalesced again.

``scd2`` appends at the run date, so batches must come in order.  Here a batch may tell of any period.  Two tables are kept:

observations  one row a key and period: the tracked values last seen in it and when.  They are the finest split of the
              key's history; a version that looks unchanged over many periods may still be split by a batch that comes later,
              and only the observations tell where it goes on after the split.
versions      the coalesced history: neighbouring observations with equal values are one half-open interval, with a
              surrogate key that a version keeps as long as there is one that starts where it started.

A batch costs the histories of the keys that it touches.  Both results are change rows (``_op``), which
``apply_changes`` lays over the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import write_table
from .dims import _list, apply_changes, coalesce_periods
from .keys import assign_keys, max_key
from .latest import latest_per_key
from .merge import OP

SEEN = "_seen"


def observations(batch: DataFrame, key, tracked, order_by: str, tie_break, period: Column | None = None, effective: str = "effective_date") -> DataFrame:
    """The last row of each key and period of a batch, with ``_seen`` (order and tie-break), which decides between batches."""
    key, tracked = _list(key), _list(tracked)
    per = period if period is not None else F.to_date(F.col(order_by))
    last = latest_per_key(batch.na.drop(subset=[*key, order_by]).withColumn(effective, per), [*key, effective], order_by, tie_break)
    return last.select(*key, effective, *tracked, F.struct(order_by, *tie_break).alias(SEEN))


def split_by(obs: DataFrame, new: DataFrame, key, effective: str = "effective_date") -> DataFrame:
    """Of the observations ``new`` of a batch those that split or replace what ``obs`` holds, with ``_op``.

    A period that was seen before takes the later of both observations, whichever batch came first.
    """
    on = [*_list(key), effective]
    old = obs.select(*on, F.col(SEEN).alias("__was"), F.lit(True).alias("__there"))
    j = new.join(old, on, "left")
    kept = j.filter(F.col("__there").isNull() | (F.col(SEEN) > F.col("__was")))
    return kept.select(*new.columns, F.when(F.col("__there"), F.lit("UPDATE")).otherwise(F.lit("INSERT")).alias(OP))


def scd2_late(dim: DataFrame, obs: DataFrame, batch: DataFrame, key, tracked, order_by: str, tie_break, sk_col: str, *, period: Column | None = None,
              effective: str = "effective_date", expiry: str = "expiry_date", current: str = "current_flag") -> tuple[DataFrame, DataFrame]:
    """(changes of ``dim``, changes of ``obs``) that a batch of any period makes; both hold rows of touched keys only.

    In whatever order batches come, the versions end up as :func:`scd2_from_history` of all of them gives them.  A version
    that a late batch takes the place of comes out as DELETE, one that it shortens or prolongs as UPDATE under its old
    key, a new one as INSERT.  Rows with a null key or time are left out; repeated rows and replayed batches change nothing.
    """
    key, tracked = _list(key), _list(tracked)
    new = observations(batch, key, tracked, order_by, tie_break, period, effective)
    new = write_table(new, scratch_path(batch.sparkSession, "observed"))  # read three times; its size tells whether it may be broadcast
    splits = write_table(split_by(obs.join(new.select(*key).distinct(), key, "left_semi"), new, key, effective), scratch_path(batch.sparkSession, "splits"))
    touched = splits.select(*key).distinct()
    history = apply_changes(obs.join(touched, key, "left_semi"), splits, [*key, effective]).drop(SEEN)
    now = coalesce_periods(history, key, tracked, effective, expiry, current)
    was = dim.join(touched, key, "left_semi").select(*[F.col(c).alias(c if c in (*key, effective) else f"__was_{c}") for c in dim.columns])
    now = now.withColumn("__now", F.lit(True))
    j = write_table(now.join(was, [*key, effective], "full_outer"), scratch_path(batch.sparkSession, "versions"))  # of touched keys
    values = [c for c in dim.columns if c not in (*key, effective, sk_col)]
    gone = j.filter("`__now` is null").select(*[F.col(c) if c in (*key, effective) else F.col(f"__was_{c}").alias(c) for c in dim.columns], F.lit("DELETE").alias(OP))
    both = j.filter(F.col("__now") & F.col(f"__was_{sk_col}").isNotNull())
    other = ~F.struct(*values).eqNullSafe(F.struct(*[F.col(f"__was_{c}").alias(c) for c in values]))
    changed = both.filter(other).select(*[F.col(f"__was_{sk_col}").alias(sk_col) if c == sk_col else F.col(c) for c in dim.columns], F.lit("UPDATE").alias(OP))
    added = j.filter(F.col("__now") & F.col(f"__was_{sk_col}").isNull()).select(*[c for c in dim.columns if c != sk_col])
    added = assign_keys(added, sk_col, [*key, effective], start=max_key(dim, sk_col)).select(*dim.columns, F.lit("INSERT").alias(OP))
    return gone.unionByName(changed).unionByName(added), splits
