"""Dimensions (D-1 ... D-4, D-7): insert-only lookups, SCD1, SCD2 and role-playing views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rows import row_changed
from ..session import scratch_path
from ..sources.tables import write_table
from .keys import assign_keys, max_key
from .merge import OP, S
from .touched import merge_touched


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def _drop_null_keys(df: DataFrame, key) -> DataFrame:
    return df.na.drop(subset=key)


def unique_source(batch: DataFrame, key, attrs, what: str = "dimension") -> DataFrame:
    """Distinct (key, attrs) rows of a batch, one per non-null key (M-4, Q6).

    The distinct rows come first, by a hash aggregation (map-side, so a hot key is cheap; a struct's minimum alone would sort all
    rows of the batch).  Of these few one grouping keeps the attribute set per key; when there are two the
    job fails with ``raise_error`` -- inside the same job that computes the
    rows, so the check costs no extra pass and nothing is published.  Rows
    with a null key never match anything and are kept distinct, as in SQL.
    """
    key, attrs = _list(key), _list(attrs)
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    nulls = batch.filter(any_null).select(*key, *attrs).distinct()
    if not attrs:
        return batch.filter(~any_null).select(*key).distinct().unionByName(nulls)
    g = (batch.filter(~any_null).select(*key, *attrs).distinct().groupBy(*key)
         .agg(F.min(F.struct(*attrs)).alias("__lo"), F.count(F.lit(1)).alias("__sets")))
    msg = F.concat(F.lit(f"AmbiguousMergeError: two attribute sets for one key in {what}: "),
                   F.to_json(F.struct(*key)))
    checked = g.select(*[F.when(F.col("__sets") == 1, F.col(k))
                         .otherwise(F.raise_error(msg)).alias(k) if i == 0 else F.col(k)
                         for i, k in enumerate(key)],
                       *[F.col(f"__lo.{a}").alias(a) for a in attrs])
    return checked.unionByName(nulls)


def empty_dim(spark, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def apply_changes(table: DataFrame, changes: DataFrame, on) -> DataFrame:
    """``table`` with change rows (``_op``) laid over it by the identifying columns ``on``."""
    rest = table.join(changes.select(*_list(on)), _list(on), "left_anti").select(*table.columns)
    return rest.unionByName(changes.filter(F.col(OP) != "DELETE").select(*table.columns))


def _first_key(dim: DataFrame, sk_col: str, start: int | None) -> int:
    return max_key(dim, sk_col) if start is None else start


def lookup_dim(dim: DataFrame, values: DataFrame, key, sk_col: str, null_keys: str = "literal",
               changes_only: bool = False, start: int | None = None) -> DataFrame:
    """Insert-only dimension (D-2 = W-2 -> M-3 -> D-4): new distinct values get new keys.

    ``changes_only`` returns just the new rows with ``_op`` (what a versioned
    table appends) instead of the whole new dimension.  ``start`` is the largest key
    so far where the caller knows it; else the dimension is asked.

    ``null_keys='literal'`` inserts a null value again on every call (a null
    never matches, as in SQL); ``'reject'`` leaves null values out.
    """
    key = _list(key)
    src = values.select(*key).distinct()
    if null_keys == "reject":
        src = _drop_null_keys(src, key)
    # the dimension is a written table: the planner's file statistics decide on broadcast
    new = src.join(dim.select(*key), key, "left_anti")
    keyed = assign_keys(new, sk_col, key, start=_first_key(dim, sk_col, start))
    if changes_only:
        return keyed.select(*dim.columns).withColumn(OP, F.lit("INSERT"))
    return dim.unionByName(keyed.select(*dim.columns))


def scd1(dim: DataFrame, batch: DataFrame, key, attrs, sk_col: str, null_keys: str = "literal",
         on_conflict: str = "raise", changes_only: bool = False, start: int | None = None) -> DataFrame:
    """Type-1 dimension (D-1 = W-3 -> M-1 -> D-4): attributes are overwritten in place.

    Two attribute sets for one key in a batch raise (``on_conflict='raise'``)
    before anything is written; ``'first'`` keeps the smallest attribute set.
    The batch's rows and those they match are written once; ``changes_only`` returns the touched rows with ``_op``.
    """
    key, attrs = _list(key), _list(attrs)
    if null_keys == "reject":
        batch = _drop_null_keys(batch, key)
    if on_conflict == "raise":
        src = unique_source(batch, key, attrs, "scd1")
    else:  # 'first': the smallest attribute set wins
        src = (batch.groupBy(*key).agg(F.min(F.struct(*attrs)).alias("__lo"))
               .select(*key, *[F.col(f"__lo.{a}").alias(a) for a in attrs]))
    src = write_table(src, scratch_path(dim.sparkSession, "scd1-batch"))
    touched = merge_touched(dim, src, key, update={a: S(a) for a in attrs}, source_unique=True)
    new = touched.filter(F.col(OP) == "INSERT").drop(OP, sk_col)
    keyed = assign_keys(new, sk_col, key, start=_first_key(dim, sk_col, start))
    changes = touched.filter(F.col(OP) == "UPDATE").unionByName(keyed.select(*dim.columns).withColumn(OP, F.lit("INSERT")))
    return changes if changes_only else apply_changes(dim, changes, sk_col)


def scd2(dim: DataFrame, batch: DataFrame, key, tracked, run_date, sk_col: str,
         effective: str = "effective_date", expiry: str = "expiry_date", current: str = "current_flag",
         null_keys: str = "literal", changes_only: bool = False, start: int | None = None) -> DataFrame:
    """Type-2 dimension (D-3), one batch at ``run_date``.

    1. expire: the current row of a key whose tracked columns differ (null-safe)
       gets ``expiry = run_date`` and ``current = false``;
    2. insert: batch rows with no current row, or a changed one, start at
       ``run_date`` with ``expiry = null`` and ``current = true``.
    Intervals are half-open: the old expiry equals the new effective date.
    The current rows that the batch meets are joined and written once; both steps read them.
    ``changes_only`` returns the touched rows with ``_op``.
    """
    key, tracked = _list(key), _list(tracked)
    rd = run_date if isinstance(run_date, Column) else F.lit(run_date).cast("date")
    if null_keys == "reject":
        batch = _drop_null_keys(batch, key)
    spark = dim.sparkSession
    src = write_table(unique_source(batch, key, tracked, "scd2"), scratch_path(spark, "scd2-batch"))
    types = {f.name: f.dataType for f in dim.schema.fields}
    typed = [F.col(c).cast(types[c]).alias(c) for c in dim.columns]
    told = src.select(*key, F.struct(*tracked).alias("__new"))
    met = dim.filter(F.coalesce(F.col(current), F.lit(False))).join(told, key, "inner")
    changed = row_changed(tracked, [F.col(f"__new.{c}") for c in tracked])
    met = write_table(met.select(*dim.columns, changed.alias("__changed")), scratch_path(spark, "scd2-met"))
    expired = met.filter("__changed").select(*[(rd if c == expiry else F.lit(False) if c == current else F.col(c)).alias(c) for c in dim.columns])
    new = src.join(met.filter("not __changed").select(*key).distinct(), key, "left_anti")
    keyed = assign_keys(new, sk_col, key, start=_first_key(dim, sk_col, start))
    keyed = keyed.select(*[
        (rd.alias(c) if c == effective else
         F.lit(None).cast("date").alias(c) if c == expiry else
         F.lit(True).alias(c) if c == current else F.col(c)) for c in dim.columns])
    changes = (expired.select(*typed).withColumn(OP, F.lit("UPDATE"))
               .unionByName(keyed.select(*typed).withColumn(OP, F.lit("INSERT"))))
    return changes if changes_only else apply_changes(dim, changes, sk_col)


def scd2_from_history(log: DataFrame, key, tracked, order_by: str, tie_break, period: Column | None = None,
                      effective: str = "effective_date", expiry: str = "expiry_date",
                      current: str = "current_flag") -> DataFrame:
    """Set-based SCD2 from a full change log (the history variant of D-3).

    The log is reduced to the last row per (key, period) first (partial top-1
    before the shuffle), then ``lag`` drops non-changes and ``lead`` gives
    the expiry.  A key's window then holds at most one row per period.
    """
    from .latest import latest_per_key
    key, tracked = _list(key), _list(tracked)
    per = period if period is not None else F.to_date(F.col(order_by))
    daily = latest_per_key(log.withColumn(effective, per), key + [effective], order_by, tie_break)
    return coalesce_periods(daily.select(*key, *tracked, effective), key, tracked, effective, expiry, current)


def coalesce_periods(periods: DataFrame, key: list, tracked: list, effective: str = "effective_date", expiry: str = "expiry_date",
                     current: str = "current_flag") -> DataFrame:
    """Versions from one row a key and period: equal neighbours become one, the next one's start is the expiry."""
    w = Window.partitionBy(*key).orderBy(effective)
    prev = F.struct(*[F.lag(c).over(w) for c in tracked])
    first = F.row_number().over(w) == 1
    kept = (periods.withColumn("__keep", first | ~F.struct(*[F.col(c) for c in tracked]).eqNullSafe(prev))
            .filter("__keep").drop("__keep"))
    return (kept.withColumn(expiry, F.lead(effective).over(w))
            .withColumn(current, F.col(expiry).isNull()))


def role_view(dim: DataFrame, prefix: str, columns=None) -> DataFrame:
    """Role-playing dimension (D-7): the same dimension under prefixed column names."""
    cols = columns or dim.columns
    return dim.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])
