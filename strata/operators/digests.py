"""Snapshot diff by digests (B-1): compare sums, descend where they differ, read rows only there.

A snapshot is written in buckets of its key (:class:`Buckets`) together with one digest a bucket: the number of rows and
two sums of row hashes, which don't depend on the rows' order.  Digests of ``fanout`` buckets add up to that of their
parent, and so on to the root.  Two snapshots are compared from the root down, and only children of nodes that differ
are looked at.  The rows of the buckets that are left are compared exactly; the others' folders aren't opened.
A change of k rows so costs a join of k buckets' rows however large the table is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import write_table
from .cdc import diff_snapshots
from .touched import BUCKET, Buckets

_SUMS = ["rows", "first", "second"]


@dataclass(frozen=True)
class Digested:
    """A snapshot: its rows in buckets, and a row a bucket with its digest."""
    rows: DataFrame
    digests: DataFrame
    buckets: Buckets


def row_hash(columns, salt: int) -> Column:
    """A hash of all columns; which of them are null is hashed too, as the hash of a null is that of nothing."""
    cols = [F.col(c) for c in columns]
    return F.xxhash64(F.lit(salt), *cols, *[c.isNull() for c in cols])


def digest_rows(df: DataFrame, columns, by) -> DataFrame:
    """``rows``, ``first`` and ``second`` (sums of two hashes, in decimals that can't overflow) for each ``by``."""
    total = lambda salt: F.coalesce(F.sum(row_hash(columns, salt).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), total(1).alias("first"), total(2).alias("second"))


def write_digested(df: DataFrame, path: str, buckets: Buckets) -> Digested:
    """Writes ``df`` and its digests under ``path``; the digests are taken of the written files."""
    rows = buckets.write(df, f"{path}/rows")
    columns = sorted(c for c in df.columns if c != BUCKET)
    return Digested(rows, write_table(digest_rows(rows, columns, [BUCKET]).coalesce(1), f"{path}/digests"), buckets)


def differing_buckets(old: DataFrame, new: DataFrame, n: int, fanout: int = 8) -> DataFrame:
    """The buckets (of ``n``) whose digests differ, found from the root down."""
    width, parents = 1, None
    while width < n:
        width *= fanout
    while True:
        def level(digests: DataFrame) -> DataFrame:
            nodes = digests.withColumn("node", F.expr(f"{BUCKET} div {width}"))  # noqa: B023
            if parents is not None:
                nodes = nodes.join(F.broadcast(parents), F.expr(f"{BUCKET} div {width * fanout}") == F.col("parent"), "left_semi")  # noqa: B023  at most n rows
            return nodes.groupBy("node").agg(*[F.sum(c).alias(c) for c in _SUMS])
        o, w = level(old), level(new)
        same = o.select("node", F.struct(*_SUMS).alias("o")).join(w.select("node", F.struct(*_SUMS).alias("w")), "node", "full_outer")
        found = same.filter(~F.col("o").eqNullSafe(F.col("w"))).select("node")
        if width == 1:
            return found.select(F.col("node").cast("int").alias(BUCKET))
        parents, width = found.select(F.col("node").alias("parent")).checkpoint(), width // fanout


def diff_digested(old: Digested, new: Digested, key, columns=None, fanout: int = 8) -> DataFrame:
    """The net change feed between two snapshots in the same buckets: as :func:`diff_snapshots`, of the differing buckets only."""
    if old.buckets != new.buckets:
        raise ValueError(f"snapshots in different buckets: {old.buckets}, {new.buckets}")
    found = [r[BUCKET] for r in differing_buckets(old.digests, new.digests, old.buckets.n, fanout).collect()]  # bucket numbers: at most n
    there = F.col(BUCKET).isin(found) if found else F.lit(False)
    return diff_snapshots(old.rows.filter(there).drop(BUCKET), new.rows.filter(there).drop(BUCKET), key, columns)
