"""MERGE / UPDATE / DELETE / INSERT as DataFrame -> DataFrame operators (M-1 ... M-9).

Built-in Parquet tables have no MERGE, so ``merge`` returns the *new state* of
the target with an ``_op`` column (``'UPDATE'``, ``'INSERT'`` or null for an
untouched row).  ``changes(...)`` keeps only the touched rows, which is what a
versioned table appends.

One ``full_outer`` join on the key aligns target and source; Spark's statistics and
AQE choose its physical form.

Inside expressions, refer to target columns with :func:`T` and source columns
with :func:`S`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .quality import assert_unique

OP = "_op"
IN_T, IN_S = "__in_t", "__in_s"


def T(c: str) -> Column:
    """Target column inside merge expressions."""
    return F.col(f"t__{c}")


def S(c: str) -> Column:
    """Source column inside merge expressions."""
    return F.col(f"s__{c}")


def _keys(on):
    return [on] if isinstance(on, str) else list(on)


def _prefixed(df: DataFrame, p: str, flag: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{p}__{c}") for c in df.columns], F.lit(True).alias(flag))


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def _salted(df: DataFrame, p: str, on) -> DataFrame:
    salt = F.when(_any_null([f"{p}__{k}" for k in on]), F.xxhash64(*[F.col(c) for c in df.columns]))
    return df.withColumn(f"__salt_{p}", F.coalesce(salt, F.lit(0).cast("bigint")))


def _same_key(on) -> Column:
    return reduce(lambda a, b: a & b, [T(k) == S(k) for k in on]) & (F.col("__salt_t") == F.col("__salt_s"))


def align(target: DataFrame, source: DataFrame, on) -> DataFrame:
    """Pair every target row with its matching source row(s), plus unmatched source rows.

    Columns: ``t__*``, ``s__*``, ``__in_t``, ``__in_s``.  A null key never
    matches.  Rows with a null key get a content-hash salt as an extra join key,
    so they spread over partitions instead of piling up in one (a full outer
    join gets no AQE skew split); the inputs are read once.
    """
    on = _keys(on)
    t = _prefixed(target, "t", IN_T)
    s = _prefixed(source, "s", IN_S)
    j = _salted(t, "t", on).join(_salted(s, "s", on), _same_key(on), "full_outer")
    return j.drop("__salt_t", "__salt_s")


def _one_per_target(target: DataFrame, source: DataFrame, on, do_upd: Column, row_id: str | None) -> DataFrame:
    """As :func:`align`, with one row for each target row: of several matches one that would
    update it (``__hits`` counts those).

    The target's rows are told apart by their key and a number, and those of a key meet in one task: a window over both reads the
    join's own partitions, so neither side is numbered beforehand and nothing is shuffled again.  Only source rows that no
    target row has come from an anti join; an empty target leaves just these.
    """
    on = _keys(on)
    rid = F.monotonically_increasing_id() if row_id is None else F.col(row_id)
    t = _salted(_prefixed(target.withColumn("__id", rid), "t", IN_T), "t", on)
    s = _salted(_prefixed(source, "s", IN_S), "s", on)
    cond = _same_key(on)
    w = Window.partitionBy(*[T(k) for k in on], "__salt_t", "t____id")
    j = (t.join(s, cond, "left_outer").withColumn("__q", F.coalesce(do_upd, F.lit(False)))
         .withColumn("__rn", F.row_number().over(w.orderBy(F.col("__q").desc())))
         .withColumn("__hits", F.sum(F.col("__q").cast("int")).over(w)).filter("__rn = 1"))
    met = _salted(_prefixed(target.select(*on), "t", IN_T), "t", on)
    new = s.join(met, cond, "left_anti")
    return j.drop("t____id", "__salt_t", "__salt_s", "__q", "__rn").unionByName(new.drop("__salt_s"), allowMissingColumns=True)


def refuse_several(rows: DataFrame, hits: str, on) -> DataFrame:
    """``rows``, or an error when one would be updated several times (M-4).  It is a filter, which stays in the plan
    whichever columns are read, also none."""
    several = F.raise_error(F.lit(f"AmbiguousMergeError: merge source is not unique on {on}: several rows would update one")).cast("boolean")
    return rows.filter(F.when(F.col(hits) > 1, several).otherwise(F.lit(True)))


def assignments(target: DataFrame, source: DataFrame, on, update, insert, set_on_update, set_on_insert) -> tuple[dict, dict]:
    """{column: expression} of the matched branch and of the not matched one."""
    tcols, scols = target.columns, set(source.columns)
    upd, ins = {}, {}
    if update is not None:
        upd = {c: S(c) for c in tcols if c not in on and c in scols} if update == "all" else dict(update)
        upd.update(set_on_update or {})
    if insert is not None:
        ins = {c: S(c) for c in tcols if c in scols} if insert == "all" else dict(insert)
        ins.update(set_on_insert or {})
    return upd, ins


def merge(target: DataFrame, source: DataFrame, on, *, update="all", insert="all",
          update_if: Column | None = None, set_on_update: dict | None = None,
          set_on_insert: dict | None = None, check_unique: bool = True,
          source_unique: bool = False, row_id: str | None = None) -> DataFrame:
    """MERGE ``source`` into ``target`` on the key columns ``on``.

    update      'all' (every non-key target column present in the source), a dict
                {col: Column}, or None (no matched branch: insert-only MERGE, M-3).
    insert      'all' (source columns by name, others null/``set_on_insert``), a
                dict {col: Column over S(...)}, or None.
    update_if   extra condition of the matched branch (M-2).
    set_on_update / set_on_insert  constant or computed columns (timestamps, counters).
    check_unique  raise before anything is written when two source rows would update
                one target row (M-4); without a condition by a check beforehand, with
                one inside the merge itself.
    source_unique  the caller knows that no key comes twice in the source.
    row_id      a column that identifies the target's rows, where it has one.
    A target row that several source rows match stays one row.
    """
    on = _keys(on)
    if check_unique and not source_unique and update is not None and update_if is None:
        assert_unique(source, on, target=target)
        source_unique = True
    tcols = target.columns
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    upd, ins = assignments(target, source, on, update, insert, set_on_update, set_on_insert)

    in_t = F.col(IN_T).isNotNull()
    in_s = F.col(IN_S).isNotNull()
    do_upd = in_t & in_s if update is not None else F.lit(False)
    if update_if is not None:
        do_upd = do_upd & F.coalesce(update_if, F.lit(False))
    j = align(target, source, on) if source_unique else _one_per_target(target, source, on, do_upd, row_id)
    if check_unique and not source_unique and update is not None:
        j = refuse_several(j, "__hits", on)
    if insert is None:
        j = j.filter(in_t)

    out = []
    for c in tcols:
        keep = T(c)
        e = F.when(do_upd, upd[c]).otherwise(keep) if c in upd else keep
        if insert is not None:
            iv = ins.get(c, F.lit(None))
            e = F.when(in_t, e).otherwise(iv.cast(ttypes[c]))
        out.append(e.cast(ttypes[c]).alias(c))
    op = F.when(do_upd, F.lit("UPDATE"))
    if insert is not None:
        op = F.when(~in_t, F.lit("INSERT")).otherwise(op)
    return j.select(*out, op.alias(OP))


def changes(merged: DataFrame) -> DataFrame:
    """Touched rows of a :func:`merge` result."""
    return merged.filter(F.col(OP).isNotNull())


def merge_counts(merged: DataFrame) -> DataFrame:
    """Affected-row counts of a merge (W-5): one row with inserted, updated, affected."""
    return merged.agg(
        F.count_if(F.col(OP) == "INSERT").alias("inserted"),
        F.count_if(F.col(OP) == "UPDATE").alias("updated"),
        F.count_if(F.col(OP).isNotNull()).alias("affected"))


def observed_counts(changes: DataFrame) -> tuple[DataFrame, Observation]:
    """(the same rows, what a write of them will have counted): rows by ``_op``, taken as the rows pass by (W-5).

    ``Observation.get`` is a dict {'INSERT': n, 'UPDATE': n, 'DELETE': n, 'rows': n} once the rows have been written; no
    other job reads them.  Put it last before the write, so that a stage that runs again isn't counted twice.
    """
    seen = Observation()
    return changes.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(OP) == x).alias(x) for x in ("INSERT", "UPDATE", "DELETE")]), seen


def update_from(target: DataFrame, source: DataFrame, on, set_cols: dict, where: Column | None = None) -> DataFrame:
    """UPDATE target SET ... FROM source WHERE key match [AND where] (M-5, J-4)."""
    return merge(target, source, on, update=set_cols, insert=None, update_if=where)


def update_where(target: DataFrame, set_cols: dict, where: Column | None = None) -> DataFrame:
    """UPDATE target SET col = expr [WHERE pred] (M-6); a null predicate updates nothing."""
    cond = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    out = [F.when(cond, set_cols[c]).otherwise(F.col(c)).cast(f.dataType).alias(c)
           if c in set_cols else F.col(c) for c, f in ((f.name, f) for f in target.schema.fields)]
    return target.select(*out, F.when(cond, F.lit("UPDATE")).alias(OP))


def delete_where(target: DataFrame, pred: Column) -> DataFrame:
    """DELETE WHERE pred (M-7); a row whose predicate is null is kept."""
    return target.filter(~F.coalesce(pred, F.lit(False)))


def clear(target: DataFrame) -> DataFrame:
    """DELETE all / TRUNCATE (M-8): the empty table of the same schema."""
    return target.limit(0)


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT ... SELECT (M-9), columns matched by name."""
    return target.unionByName(rows.select(*target.columns))
