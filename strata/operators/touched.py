"""MERGE that reads and returns only what a batch touches (M-1, M-2, M-3, M-4, J-5 on a large target).

:func:`merge` returns a target's whole new state and so reads all of it.  Here the target lies in folders by a hash
of its key (:class:`Buckets`), the batch carries the same hash, and the join on both lets Spark prune folders at run
time by the buckets that occur in the batch (dynamic partition pruning, as soon as the batch is small enough to be
broadcast).  Matched rows come from an inner join, new ones from an anti join against the matched keys; the full
outer join, which neither prunes nor broadcasts, isn't needed, as untouched rows don't come out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import write_table
from .merge import IN_S, IN_T, OP, S, T, _any_null, _keys, _prefixed, assignments, refuse_several

BUCKET = "_bucket"


@dataclass(frozen=True)
class Buckets:
    """Folders ``_bucket=0 ... n-1`` by a hash of ``keys``, which are among the keys that merges match on.

    A null key never matches, so rows with one go by a hash of the whole row and don't pile up in one folder.
    """
    keys: tuple
    n: int = 64

    def of_keys(self) -> Column:
        """The bucket in which a row with these keys, none of them null, lies."""
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.n)).cast("int")

    def add(self, df: DataFrame) -> DataFrame:
        rest = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != BUCKET]), F.lit(self.n)).cast("int")
        return df.withColumn(BUCKET, F.when(_any_null(self.keys), rest).otherwise(self.of_keys()))

    def write(self, df: DataFrame, path: str) -> DataFrame:
        """``df`` as a table in buckets, each written by one task, in up to 8 parts."""
        part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(8))
        return write_table(self.add(df).repartition(F.col(BUCKET), part), path, partition_by=[BUCKET])


def _typed(source: DataFrame, target: DataFrame, on: list) -> DataFrame:
    """``source`` with its keys in the target's types: an int and a long of one value hash differently."""
    return source.withColumns({k: F.col(k).cast(target.schema[k].dataType) for k in on})


def matched_rows(target: DataFrame, source: DataFrame, on, *, buckets: Buckets | None = None, update="all", update_if: Column | None = None,
                 set_on_update: dict | None = None, source_unique: bool = False) -> DataFrame:
    """The target rows that a source row matches, updated where the matched branch says so, with ``_op`` 'UPDATE' or null.

    Of several source rows that match one target row at most one may update it, else the job fails (M-4).  Target rows
    are told apart by their content (equal ones are counted), so recomputing a lost partition changes nothing.
    """
    on = _keys(on)
    upd, _ = assignments(target, source, on, update, None, set_on_update, None)
    types = {f.name: f.dataType for f in target.schema.fields}
    source = _typed(source, target, on)
    # by the keys alone: a filter on an expression over all columns would have its constraints copied for every alias of each of them
    t, s = _prefixed(target, "t", IN_T), _prefixed(source if buckets is None else source.withColumn(BUCKET, buckets.of_keys()), "s", IN_S)
    cond = reduce(lambda a, b: a & b, [T(k) == S(k) for k in on])
    if buckets is not None:
        s = s.filter(S(BUCKET).between(0, buckets.n - 1))  # always true; a side without any condition prunes nothing
        cond = cond & (T(BUCKET) == S(BUCKET))
    do_upd = F.lit(update is not None)
    if update_if is not None:
        do_upd = do_upd & F.coalesce(update_if, F.lit(False))
    if source_unique:
        m = t.join(s, cond, "inner").withColumn("__q", do_upd)
    else:
        hit = t.join(s, cond, "left_semi").groupBy(*t.columns).agg(F.count(F.lit(1)).alias("__copies"))
        m = hit.join(s, cond, "inner").withColumn("__q", do_upd)
        m = m.groupBy(*t.columns, "__copies").agg(F.max_by(F.struct(*s.columns), F.col("__q")).alias("__sr"), F.max("__q").alias("__q"),
                                                  F.sum(F.col("__q").cast("int")).alias("__hits"))
        m = refuse_several(m, "__hits", on).select(*t.columns, "__sr.*", "__q", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")).alias("__copy"))
    out = [(F.when(F.col("__q"), upd[c]).otherwise(T(c)) if c in upd else T(c)).cast(types[c]).alias(c) for c in target.columns]
    return m.select(*out, F.when(F.col("__q"), F.lit("UPDATE")).alias(OP))


def merge_touched(target: DataFrame, source: DataFrame, on, *, buckets: Buckets | None = None, update="all", insert="all",
                  update_if: Column | None = None, set_on_update: dict | None = None, set_on_insert: dict | None = None,
                  source_unique: bool = False) -> DataFrame:
    """The rows that MERGE of ``source`` into ``target`` updates or inserts, with ``_op``; arguments as of :func:`merge`.

    With ``buckets`` the target is a table in those buckets (or a view of one whose partition column is still there) and
    only the batch's are read.  The matched rows are written once, in the shared folder: they are output and, by their
    keys, what tells new rows from old ones.  Both sides may be empty; a null key is new each time (Q3).
    """
    on = _keys(on)
    source = _typed(source, target, on)
    _, ins = assignments(target, source, on, None, insert, None, set_on_insert)
    found = matched_rows(target, source, on, buckets=buckets, update=update, update_if=update_if, set_on_update=set_on_update,
                         source_unique=source_unique)
    found = write_table(found, scratch_path(target.sparkSession, "matched"))
    rows = found.filter(F.col(OP).isNotNull())
    if insert is None:
        return rows
    new = source.join(found.select(*on).distinct(), on, "left_anti")
    new = _prefixed(new if buckets is None else buckets.add(new), "s", IN_S)
    if buckets is not None:
        ins[BUCKET] = S(BUCKET)
    new = new.select(*[ins.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields], F.lit("INSERT").alias(OP))
    return rows.unionByName(new)
