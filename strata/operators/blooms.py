"""Key checks of a batch against history (G-5, G-6) by Bloom filters kept with the table.

A declared primary or foreign key is to hold across loads, but a batch should not scan history to show that its keys
are new.  A :class:`KeyFilter` keeps, for each bucket of keys, a bit array as rows (bucket, word, bits): it is built with one
aggregation, grows by another one over a batch's keys only, and is a few bytes a key.  A batch's keys that miss a bit are surely
not in the table; the others, hits and a few false ones, are looked up exactly, in their buckets only.  Results are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import write_table
from .merge import _any_null, _keys
from .touched import BUCKET, Buckets

_WORD, _BITS = "word", "bits"


@dataclass(frozen=True)
class KeyFilter:
    """The layout of a filter: ``bits`` a bucket (about ten for each key expected there) and ``hashes`` of them a key."""
    buckets: Buckets
    bits: int = 1 << 20
    hashes: int = 5

    def _probes(self, keys: DataFrame) -> DataFrame:
        """A row for each key and hash: ``_bucket``, ``word``, ``bits`` with the one bit set."""
        k = [F.col(c) for c in self.buckets.keys]
        places = F.array(*[F.pmod(F.xxhash64(F.lit(i + 1), *k), F.lit(self.bits)) for i in range(self.hashes)])
        out = keys.withColumn(BUCKET, self.buckets.of_keys()).withColumn("__place", F.explode(places))
        return out.withColumns({_WORD: F.floor(F.col("__place") / 64).cast("int"), _BITS: F.expr("shiftleft(1L, cast(__place % 64 as int))")}).drop("__place")

    def words(self, rows: DataFrame) -> DataFrame:
        """The filter of the keys of ``rows``; null keys aren't in it."""
        keys = rows.select(*self.buckets.keys)
        return self._merged(self._probes(keys.filter(~_any_null(self.buckets.keys))))

    def extend(self, words: DataFrame, rows: DataFrame) -> DataFrame:
        """``words`` with the keys of ``rows`` added; the table's other rows aren't read."""
        return self._merged(words.unionByName(self.words(rows)))

    @staticmethod
    def _merged(words: DataFrame) -> DataFrame:
        return words.groupBy(BUCKET, _WORD).agg(F.bit_or(_BITS).alias(_BITS))

    def possible(self, words: DataFrame, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (distinct, not null) all of whose bits are set: all that are in the table, and a few others."""
        k = list(self.buckets.keys)
        w = words.select(BUCKET, _WORD, F.col(_BITS).alias("__set"))
        met = self._probes(keys).join(w, [BUCKET, _WORD], "left")
        hit = F.coalesce(F.col("__set").bitwiseAND(F.col(_BITS)) != 0, F.lit(False))
        return met.groupBy(*k).agg(F.bool_and(hit).alias("__hit")).filter("__hit").drop("__hit")


def _batch_keys(batch: DataFrame, columns: list, names: list, like: DataFrame) -> DataFrame:
    """``columns`` of the batch, not null, under the table's names and in its types."""
    out = batch.filter(~_any_null(columns)).select(*[F.col(c).cast(like.schema[n].dataType).alias(n) for c, n in zip(columns, names, strict=True)])
    return out


def _looked_up(table: DataFrame, found: DataFrame, flt: KeyFilter) -> DataFrame:
    """Keys of the rows of ``table`` (in buckets) that have one of the keys ``found``, read from those buckets' folders."""
    found = write_table(found, scratch_path(table.sparkSession, "possible"))  # its size tells whether it may be broadcast
    found = found.withColumn(BUCKET, flt.buckets.of_keys()).filter(F.col(BUCKET).between(0, flt.buckets.n - 1))
    k = list(flt.buckets.keys)
    return table.select(*k, BUCKET).join(found, [*k, BUCKET], "left_semi").select(*k)


def duplicate_keys_of_batch(table: DataFrame, words: DataFrame, batch: DataFrame, flt: KeyFilter, count_col: str = "n") -> DataFrame:
    """Keys of the batch that are null, or occur more than once in table and batch together, with that number (G-5).

    ``table`` is in ``flt``'s buckets and ``words`` its filter, both without the batch.
    """
    k = list(flt.buckets.keys)
    there = flt.possible(words, _batch_keys(batch, k, k, table).distinct())
    old = _looked_up(table, there, flt).groupBy(*k).agg(F.count(F.lit(1)).alias("__old"))
    new = batch.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in k]).groupBy(*k).agg(F.count(F.lit(1)).alias("__new"))
    n = F.col("__new") + F.coalesce("__old", F.lit(0))
    return new.join(old, k, "left").select(*k, n.alias(count_col)).filter((F.col(count_col) > 1) | _any_null(k))


def orphans_of_batch(batch: DataFrame, dim: DataFrame, words: DataFrame, flt: KeyFilter, fk) -> DataFrame:
    """Rows of the batch whose non-null foreign key ``fk`` has no row in ``dim`` (in buckets, with the filter ``words``) (G-6)."""
    fk, k = _keys(fk), list(flt.buckets.keys)
    keys = _batch_keys(batch, fk, k, dim).distinct()
    known = _looked_up(dim, flt.possible(words, keys), flt).distinct().select(*[F.col(p).alias(f) for p, f in zip(k, fk, strict=True)])
    return batch.filter(~_any_null(fk)).join(known, fk, "left_anti").select(*batch.columns)
