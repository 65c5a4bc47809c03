"""Mixing sources to target weights by temperature, in DataFrame functions only.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources equal) and 1 (as
they are), normalised.  The exponent is bisected on a fixed grid to the largest one whose weights reach a target
entropy, but no source may be repeated more often than a limit.  The weights are realised as passes over each
source: whole passes, and for the rest a prefix of a permutation of its blocks that meets the source's token budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import col, written

#: Steps of the exponent's grid, and points that are tried at once (four steps of a bisection a job).
GRID = 1 << 20
_FAN = 16
BLOCK_TOKENS = 1 << 20


def order_key(*parts) -> Column:
    """A number below 2^60 from the MD5 of the parts joined by colons (nulls as empty texts)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def word_count(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none in a null."""
    return F.coalesce(F.regexp_count(col(text).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def exponent(shares: DataFrame, total: int, budget: float, min_entropy: float, max_repeats: float) -> float:
    """The largest grid point whose weights have at least ``min_entropy`` of the greatest entropy, raised as far as the
    repetition limit needs.  ``shares`` has a positive ``p`` for each source; each job tries many points in one sum."""
    n, least = shares.agg(F.count("*"), F.min("p")).first()
    if not n or n == 1:
        return 1.0
    goal = min_entropy * math.log(n)

    def sums(points: list[int]) -> dict[int, tuple[float, float]]:
        got = shares.agg(*[f for g in points for f in (F.sum(F.pow("p", F.lit(g / GRID))), F.sum(F.pow("p", F.lit(g / GRID)) * F.log("p")))]).first()
        return {g: (got[2 * i], got[2 * i + 1]) for i, g in enumerate(points)}

    def bisect(ok) -> tuple[int, int]:
        """The greatest point for which ``ok`` (true up to some point) holds and the next; (-1, 0) where none does."""
        low, high = -1, GRID + 1
        while high - low > 1:
            points = sorted({low + (high - low) * i // _FAN for i in range(1, _FAN)} - {low, high}) or [low + 1]
            for g, (z, s) in sums(points).items():
                if ok(g / GRID, z, s):
                    low = max(low, g)
                else:
                    high = min(high, g)
        return low, high

    mixed, _ = bisect(lambda a, z, s: math.log(z) - a * s / z >= goal - 1e-12)
    _, lowest = bisect(lambda a, z, s: least ** (a - 1) / z * budget / total > max_repeats + 1e-12)
    return min(GRID, max(mixed, lowest, 0)) / GRID


def mixing_plan(docs: DataFrame, doc_id: str, source: str, tokens: str, *, budget: int | None = None, min_entropy: float = 0.95,
                max_repeats: float = 4.0, block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """One row a source: ``source``, ``tokens``, ``weight``, ``repeats`` (token budget / tokens), ``blocks``, ``passes`` (whole
    ones) and where the permutation of blocks of the last pass is cut: after documents of a lower (block order, document order).

    ``docs`` has ids, sources and token counts only; it is read several times, so give a written table.
    """
    by = written(docs.groupBy(col(source).alias("source")).agg(F.sum(col(tokens)).alias("tokens")))
    total = by.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    aim = min(total if budget is None else budget, max_repeats * total)
    shares = written(by.filter("tokens > 0").select("source", "tokens", (F.col("tokens") / F.lit(float(total))).alias("p")))
    a = exponent(shares, total, aim, min_entropy, max_repeats)
    z = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0
    weighed = shares.withColumn("weight", F.pow("p", F.lit(a)) / F.lit(z)).withColumn("repeats", F.col("weight") * F.lit(float(aim)) / F.col("tokens"))
    plan = by.filter("tokens = 0 or tokens is null").select("source", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.lit(0.0).alias("weight"),
                                                           F.lit(1.0).alias("repeats")).unionByName(weighed.select("source", "tokens", "weight", "repeats"))
    plan = plan.withColumns({"blocks": F.ceil((F.col("tokens") + 1) / F.lit(block_tokens)).cast("long"),
                             "passes": F.floor(F.col("repeats") + 1e-9).cast("long")})
    plan = written(plan.withColumn("rest", F.floor((F.col("repeats") - F.col("passes")) * F.col("tokens") + 1e-6).cast("long")))
    d = docs.select(col(source).alias("s"), col(tokens).alias("t"), col(doc_id).alias("i")).join(
        plan.filter("rest > 0"), F.col("s").eqNullSafe(F.col("source")))
    d = d.select("source", "rest", "t", *_orders(F.col("i"), F.col("source"), F.col("blocks"), F.col("passes") + 1, seed))
    blocks = d.groupBy("source", "block_order").agg(F.sum("t").alias("t"), F.first("rest").alias("rest"))
    w = Window.partitionBy("source").orderBy("block_order")  # one row a block, of about block_tokens
    cut = written(blocks.withColumn("before", F.sum("t").over(w) - F.col("t")).filter("before <= rest and before + t > rest").groupBy("source").agg(
        F.max(F.struct("block_order", (F.col("rest") - F.col("before")).alias("left"))).alias("c")).select("source", "c.*"))
    inside = d.join(cut.select(F.col("source").alias("s"), F.col("block_order").alias("b"), "left"),
                    F.col("source").eqNullSafe(F.col("s")) & (F.col("block_order") == F.col("b")))
    w = Window.partitionBy("source").orderBy("doc_order").rangeBetween(Window.unboundedPreceding, 0)  # the documents of one block
    last = inside.withColumn("upto", F.sum("t").over(w)).filter("upto <= left").groupBy("source").agg(F.max("doc_order").alias("cut_doc"))
    ends = cut.select(F.col("source").alias("s"), F.col("block_order").alias("cut_block"))
    ends = ends.join(last, F.col("s").eqNullSafe(F.col("source")), "left").select("s", "cut_block", F.coalesce("cut_doc", F.lit(-1)).alias("cut_doc"))
    return written(plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))


def _orders(doc_id: Column, source: Column, blocks: Column, epoch: Column, seed: int) -> list[Column]:
    block = F.pmod(order_key(seed, "block", doc_id), blocks)
    return [order_key(seed, "order", epoch, source, block).alias("block_order"), order_key(seed, "doc", epoch, doc_id).alias("doc_order")]


def mix_sources(docs: DataFrame, plan: DataFrame, doc_id: str = "doc_id", source: str = "source", *, seed: int = 0) -> DataFrame:
    """``docs``, all columns, each row once for each pass that takes it: the whole passes of its source, and the last if it lies
    before the cut.  Added: ``epoch`` from 1, ``block_order`` and ``doc_order``; reading a pass by them is its block permutation.

    ``plan`` comes from ``mixing_plan`` over the same rows.  A null source is a source.  A source without tokens passes once.
    Rows with equal ids take the same place; so a cut takes all of them or none.  An empty table gives an empty result.
    """
    p = plan.select(F.col("source").alias("__source"), "blocks", "passes", "rest", "cut_block", "cut_doc")
    p = p.select("__source", F.struct("blocks", "passes", "rest", "cut_block", "cut_doc").alias("__plan"))
    names = [c for c in docs.columns if c.lower() not in ("epoch", "block_order", "doc_order")]
    d = docs.select(*[col(c) for c in names]).join(p, col(source).eqNullSafe(F.col("__source")))
    g = lambda x: F.col("__plan").getField(x)
    block, doc = _orders(col(doc_id), col(source), g("blocks"), g("passes") + 1, seed)
    taken = (g("rest") > 0) & (g("cut_block").isNull() | (block < g("cut_block")) | ((block == g("cut_block")) & (doc <= g("cut_doc"))))
    d = d.withColumn("__copies", g("passes") + F.coalesce(taken, F.lit(False)).cast("long")).filter("__copies > 0")
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return d.select(*[col(c) for c in names], "epoch", *_orders(col(doc_id), col(source), g("blocks"), F.col("epoch"), seed))
