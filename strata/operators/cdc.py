"""Change data capture (B-1 ... B-5).

A change feed row is a data row plus ``_action`` ('INSERT' | 'DELETE') and
``_is_update``.  An update is a DELETE (before image) and an INSERT (after
image), both with ``_is_update = true``; several changes of one row between
two reads fold into one net change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rows import row_changed
from .merge import IN_S, IN_T, S, T, align

ACTION, IS_UPDATE, VERSION = "_action", "_is_update", "_version"


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def diff_snapshots(old: DataFrame, new: DataFrame, key, columns=None) -> DataFrame:
    """Net change feed between two snapshots keyed by ``key`` (one pass, one join).

    Unchanged rows produce nothing; the comparison is null-safe.
    """
    key = _list(key)
    cols = columns or new.columns
    vals = [c for c in cols if c not in key]
    j = align(old.select(*cols), new.select(*cols), key)
    in_o, in_n = F.col(IN_T).isNotNull(), F.col(IN_S).isNotNull()
    both = in_o & in_n
    changed = both & row_changed([T(c) for c in vals], [S(c) for c in vals])
    imgs = F.array(
        F.when(in_o & (~in_n | changed),
               F.struct(F.lit("DELETE").alias(ACTION), changed.alias(IS_UPDATE), *[T(c).alias(c) for c in cols])),
        F.when(in_n & (~in_o | changed),
               F.struct(F.lit("INSERT").alias(ACTION), changed.alias(IS_UPDATE), *[S(c).alias(c) for c in cols])))
    return (j.select(F.explode(imgs).alias("__r")).filter(F.col("__r").isNotNull())
            .select(*[F.col(f"__r.{c}").alias(c) for c in cols], f"__r.{ACTION}", f"__r.{IS_UPDATE}"))


def net_changes(log: DataFrame, key, from_version: int = 0, to_version: int | None = None,
                version_col: str = VERSION) -> DataFrame:
    """Fold a per-version change log into one net change per row (B-1, B-5).

    ``log`` holds change-feed rows with ``version_col``; only versions in
    ``(from_version, to_version]`` are read (a feed created at version v starts
    at v).  Per row: the before image is the DELETE image of its first change
    in range, the after image the INSERT image of its last change.  One
    grouping pass with map-side partial aggregation (``min_by``/``max_by``).
    """
    key = _list(key)
    data = [c for c in log.columns if c not in (ACTION, IS_UPDATE, version_col)]
    rng = F.col(version_col) > from_version
    if to_version is not None:
        rng = rng & (F.col(version_col) <= to_version)
    rank = F.when(F.col(ACTION) == "DELETE", 0).otherwise(1)
    order = F.struct(F.col(version_col), rank)
    img = F.struct(F.col(ACTION).alias("a"), *[F.col(c).alias(c) for c in data])
    g = (log.filter(rng).groupBy(*key)
         .agg(F.min_by(img, order).alias("__first"), F.max_by(img, order).alias("__last")))
    before = F.col("__first.a") == "DELETE"
    after = F.col("__last.a") == "INSERT"
    vals = [c for c in data if c not in key]
    changed = before & after & row_changed([F.col(f"__first.{c}") for c in vals], [F.col(f"__last.{c}") for c in vals])
    upd = before & after
    imgs = F.array(
        F.when(before & (~after | changed),
               F.struct(*[F.col(f"__first.{c}").alias(c) for c in data], F.lit("DELETE").alias(ACTION),
                        upd.alias(IS_UPDATE))),
        F.when(after & (~before | changed),
               F.struct(*[F.col(f"__last.{c}").alias(c) for c in data], F.lit("INSERT").alias(ACTION),
                        upd.alias(IS_UPDATE))))
    return (g.select(F.explode(imgs).alias("__r")).filter(F.col("__r").isNotNull())
            .select(*[F.col(f"__r.{c}").alias(c) for c in data], f"__r.{ACTION}", f"__r.{IS_UPDATE}"))


def after_images(feed: DataFrame) -> DataFrame:
    """INSERT rows of a feed: new rows and the after images of updates (B-4)."""
    return feed.filter(F.col(ACTION) == "INSERT")


def has_changes(feed: DataFrame) -> DataFrame:
    """One-row DataFrame ``has_data`` (B-2); reads at most one row of the feed per partition."""
    return feed.select(F.lit(1).alias("__x")).limit(1).agg(
        (F.count(F.lit(1)) > 0).cast("boolean").alias("has_data"))
