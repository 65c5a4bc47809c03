"""Sharding by sampled splitters, in DataFrame functions only.

Keys are drawn with a probability in proportion to the rows' sizes; their quantiles are the boundaries of ranges, a few
to a shard; ranges that turn out overfull are drawn from again and subdivided, one that holds a single key by the
text's checksum.  Rows are then ordered within their ranges only, and the ranges' sums tell where in the whole order
each row lies; shards are equal parts of that order by size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import col, written

SHARDS = 40
ROWS_PER_RANGE = 2_000_000
_COPIES_AT_ONCE = 100_000


def _ranged(base: DataFrame, bounds: list) -> DataFrame:
    """``base`` with ``range``, the number of boundaries below the key (0 for a null key): found first among every g-th
    boundary, then within that group of them."""
    if not bounds:
        return base.withColumn("range", F.lit(0).cast("long"))
    g = math.isqrt(len(bounds)) + 1
    groups = [bounds[i:i + g] for i in range(0, len(bounds), g)]
    below = lambda a: F.coalesce(F.size(F.filter(a, lambda b: b < F.col("key"))), F.lit(0))
    ends, members = F.array(*[F.lit(x[-1]) for x in groups]), F.array(*[F.array(*[F.lit(b) for b in x]) for x in groups])
    outer = base.withColumn("__g", below(ends))
    # past the last group get() gives null: no more boundaries; a null key is below none
    place = F.col("__g") * g + F.when(F.col("__g") < len(groups), below(F.get(members, F.col("__g")))).otherwise(F.lit(0))
    last = F.when(F.col("__g") >= len(groups), F.lit(len(bounds))).otherwise(place)
    return outer.withColumn("range", F.when(F.col("key").isNull(), F.lit(0)).otherwise(last).cast("long")).drop("__g")


def _drawn(rows: DataFrame, per: float, parts: dict[int, int], seed: int) -> list:
    """Boundaries from a draw of one key for every ``per`` bytes: for each range the quantiles into its number of parts."""
    weight = F.col("bytes") / F.lit(per)
    u = F.pmod(F.xxhash64("key", "text_crc32", "size", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    s = rows.filter(u < weight).select("range", "key", F.greatest(weight, F.lit(1.0)).alias("w")).filter("key is not null")
    w = Window.partitionBy("range")  # a bounded draw: samples of a range
    cum = F.sum("w").over(w.orderBy("key").rangeBetween(Window.unboundedPreceding, 0))
    n = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in parts.items() for x in kv]), F.col("range"))
    s = s.withColumn("q", F.ceil(cum * n / F.sum("w").over(w))).groupBy("range", "q").agg(F.max("key").alias("key"))
    return sorted({r["key"] for r in s.select("key").collect()})


def _split(ranged: DataFrame, full: dict[int, int], mean: float, overfull: float, samples: int, seed: int) -> set:
    """More boundaries for overfull ranges: quantiles of a finer draw, and either side of a key that alone is too much."""
    rows = ranged.filter(F.col("range").isin(*full))
    more = set(_drawn(rows, mean / samples / 4, full, seed))
    heavy = rows.groupBy("range", "key").agg(F.sum("bytes").alias("b")).filter((F.col("b") > overfull * mean) & F.col("key").isNotNull())
    heavy = {r["range"]: r["key"] for r in heavy.groupBy("range").agg(F.max("key").alias("key")).collect()}
    if heavy:
        top = F.element_at(F.create_map(*[F.lit(x) for kv in heavy.items() for x in kv]), F.col("range").cast("int"))
        before = rows.groupBy("range").agg(F.max(F.when(F.col("key") < top, F.col("key"))).alias("key")).collect()
        more |= {*heavy.values(), *(r["key"] for r in before if r["key"] is not None)}
    return more


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", *, n_shards: int = SHARDS, ranges_per_shard: int = 8,
          samples_per_range: int = 32, rows_per_range: int = ROWS_PER_RANGE, overfull: float = 2.0, seed: int = 0) -> DataFrame:
    """``key``, ``size`` (UTF-8 bytes and 16), ``text_crc32``, ``law`` ('bytes'), ``shard``, ``slot`` (from 0, gapless), ``grown_shard`` (null)
    of every row: the order by (key, checksum, size), nulls first, cut into ``n_shards`` parts of near equal size.

    A row belongs to the shard in which its middle byte lies; so shards differ by less than two largest rows.
    Ranges number ``ranges_per_shard`` a shard, or one for ``rows_per_range`` rows if that is more; what is drawn and
    what the driver holds (boundaries) grows with their number only.  Equal rows are counted before the shuffle, so no
    number of them makes a range overfull.  A null text counts as empty.  An empty table gives an empty result; with fewer rows than shards some stay empty.
    """
    base = docs.select(col(key).alias("key"), (F.coalesce(F.octet_length(col(text).cast("string")), F.lit(0)) + 16).cast("long").alias("size"),
                       F.crc32(F.coalesce(col(text).cast("string"), F.lit("")).cast("binary")).alias("text_crc32"))
    base = written(base.groupBy("key", "size", "text_crc32").agg(F.count("*").alias("copies")).withColumn("bytes", F.col("size") * F.col("copies")))
    total, rows = base.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    n = max(n_shards * ranges_per_shard, math.ceil(rows / rows_per_range))
    mean = max(1.0, total / n)
    bounds = _drawn(base.withColumn("range", F.lit(0).cast("long")), mean / samples_per_range, {0: n}, seed)[:-1]
    while True:
        ranged = _ranged(base, bounds)
        sums = ranged.groupBy("range").agg(F.sum("bytes").alias("b"), (F.min("key") < F.max("key")).alias("several"))
        big = sums.filter(F.col("b") > overfull * mean).collect()  # fewer than n rows
        full = {r["range"]: math.ceil(r["b"] / mean) for r in big if r["several"]}
        more = _split(ranged, full, mean, overfull, samples_per_range, seed + len(bounds)) - set(bounds) if full else set()
        if not more:
            break
        bounds = sorted({*bounds, *more})
    lone = {r["range"]: math.ceil(r["b"] / mean) for r in big if not r["several"]}
    part = F.lit(0).cast("long")
    if lone:  # an overfull range of one key: by the checksum, which is next in the order
        parts = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in lone.items() for x in kv]), F.col("range"))
        part = F.floor(F.col("text_crc32") * F.coalesce(parts, F.lit(0)) / F.lit(float(1 << 32))).cast("long")
    ranged = ranged.withColumn("part", part)
    offsets = ranged.groupBy("range", "part").agg(F.sum("bytes").alias("b"), F.sum("copies").alias("c"))
    w = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = offsets.select("range", "part", F.coalesce(F.sum("b").over(w), F.lit(0)).alias("b0"), F.coalesce(F.sum("c").over(w), F.lit(0)).alias("c0"))
    w = Window.partitionBy("range", "part").orderBy(F.col("key").asc_nulls_first(), "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = ranged.withColumns({"b1": F.coalesce(F.sum("bytes").over(w), F.lit(0)), "c1": F.coalesce(F.sum("copies").over(w), F.lit(0))})
    at = at.join(F.broadcast(offsets), ["range", "part"])  # a row a range
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_COPIES_AT_ONCE).cast("long")))
    at = at.withColumn("from", first)
    at = at.withColumn("copy", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + _COPIES_AT_ONCE, F.col("copies")) - 1)))
    at = at.withColumn("middle", F.col("b0") + F.col("b1") + F.col("copy") * F.col("size") + F.shiftright("size", 1))
    placed = written(at.select("key", "size", "text_crc32", (F.col("c0") + F.col("c1") + F.col("copy")).alias("place"), F.least(
        F.lit(n_shards - 1), F.expr(f"cast(middle * {n_shards} div {max(total, 1)} as int)")).alias("shard")))
    starts = placed.groupBy("shard").agg(F.min("place").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(  # a row a shard
        F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
