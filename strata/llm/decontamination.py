"""Benchmark decontamination by a prefix-filtered containment join.

A window of an item (``window`` consecutive words, or a whole shorter item) is a set of shingles.  A text
that contains the window contains its rarest shingle, so that one is a sufficient prefix.

1. Count how often each shingle of the items occurs in all documents, and take each window's rarest.
2. Look up the prefixes among a document's shingles.  A match fixes where the window would start: it must
   lie inside the text (bounds on position and length), and its words must be equal, one by one.

Items are dealt with in blocks of bounded size, one broadcast at a time, whatever the size of the benchmark.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import col, field, map_text, ship, without, written

SHINGLE = 5
BLOCK_BYTES = 32 << 20
COLUMNS = ["n_words", "n_hit", "n_items", "item_ids", "items_sha256", "contaminated"]
_FILTER_BITS = 16


class Windows:
    """All windows of some items: word hashes, lower-cased words, and the shingles that may be prefixes."""

    def __init__(self, ids: list[str | None], texts: list[str], size: int):
        self.ids, self.item, self.words, self.exact, self.shingles = ids, [], [], [], []
        for n, text in enumerate(texts):
            raw = np.frombuffer(text.encode(), np.uint8)
            starts, ends, _ = W.spans(raw, np.array([0, len(raw)]))
            h, low = W.hashes(raw, starts, ends), W.LOWER[raw].tobytes()
            parts = [low[a:b] for a, b in zip(starts, ends, strict=True)]
            for i in range(max(1, len(parts) - size + 1) if parts else 0):
                w = h[i:i + size]
                self.item.append(n)
                self.words.append(w)
                self.exact.append(parts[i:i + size])
                k = min(SHINGLE, len(w))
                self.shingles.append((k, W.shingles(w, np.array([0, len(w)]), k)[0]))

    def by_length(self) -> dict[int, np.ndarray]:
        """The distinct shingles, sorted, by their number of words."""
        return {k: np.unique(np.concatenate([s for n, s in self.shingles if n == k])) for k in {n for n, _ in self.shingles}}

    def prefixes(self, counts: dict[int, dict[int, int]]) -> dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]]:
        """By shingle length: the windows' rarest shingles, sorted, and the (window, place of the shingle) of each."""
        found: dict[int, dict[int, list]] = {}
        for n, (k, s) in enumerate(self.shingles):
            at = min(range(len(s)), key=lambda i: (counts.get(k, {}).get(int(s[i]), 0), int(s[i])))
            found.setdefault(k, {}).setdefault(int(s[at]), []).append((n, at))
        return {k: (np.array(sorted(d), np.uint64), [d[x] for x in sorted(d)]) for k, d in found.items()}


def _filters(keys: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """A bitmap of the leading bits of the keys, by shingle length: most shingles are settled by one look."""
    out = {}
    for k, x in keys.items():
        out[k] = np.zeros(1 << _FILTER_BITS, bool)
        out[k][(x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return out


def _matches(sh: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``sh`` whose shingle is a key, and that key's place."""
    near = np.flatnonzero(bits[(sh >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    at = np.minimum(np.searchsorted(keys, sh[near]), len(keys) - 1)
    ok = keys[at] == sh[near]
    return near[ok], at[ok]


def _occurrences(docs: DataFrame, text: str, windows: Windows) -> dict[int, dict[int, int]]:
    """How often each shingle of the windows occurs in all documents: as many numbers as the windows have shingles."""
    keys = docs.sparkSession.sparkContext.broadcast(windows.by_length())

    def count(batches):
        mine = keys.value
        bits, sums = _filters(mine), {k: np.zeros(len(x), np.int64) for k, x in mine.items()}
        for b in batches:
            for _, _, data, off in W.chunks(b.column(0).fill_null("")):
                starts, ends, first = W.spans(data, off)
                h = W.hashes(data, starts, ends)
                for k, x in mine.items():
                    _, at = _matches(W.shingles(h, first, k)[0], x, bits[k])
                    sums[k] += np.bincount(at, minlength=len(x))
        for k, n in sums.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int64)), pa.array(mine[k][some].view(np.int64)),
                                              pa.array(n[some])], names=["k", "shingle", "n"])

    rows = docs.select(col(text).cast("string")).mapInArrow(count, "k long, shingle long, n long")
    out: dict[int, dict[int, int]] = {}
    for k, s, n in rows.groupBy("k", "shingle").agg(F.sum("n")).collect():
        out.setdefault(k, {})[s % (1 << 64)] = n
    return out


def _search(docs: DataFrame, text: str, windows: Windows, name: str) -> DataFrame:
    """``docs`` with a column ``name``: words, spans of words inside windows (merged, flat), and the items' ids."""
    shared = docs.sparkSession.sparkContext.broadcast((windows, windows.prefixes(_occurrences(docs, text, windows))))

    def make():
        win, prefix = shared.value
        bits = _filters({k: x for k, (x, _) in prefix.items()})

        def run(texts):
            n_words, hit_spans, hit_items = [], [], []
            for i, j, data, off in W.chunks(texts):
                starts, ends, first = W.spans(data, off)
                h, low, found = W.hashes(data, starts, ends), None, {}
                for k, (keys, places) in prefix.items():
                    sh, at = W.shingles(h, first, k)
                    where, which = _matches(sh, keys, bits[k])
                    if len(where) and low is None:
                        low = W.LOWER[data].tobytes()
                    owner = np.searchsorted(at, where, "right") - 1
                    for p, key, t in zip((where - at[owner] + first[owner]).tolist(), which.tolist(), owner.tolist(), strict=True):
                        for w, place in places[key]:
                            a, n = p - place, len(win.words[w])
                            if a < first[t] or a + n > first[t + 1] or not np.array_equal(h[a:a + n], win.words[w]):
                                continue
                            if [low[x:y] for x, y in zip(starts[a:a + n], ends[a:a + n], strict=True)] == win.exact[w]:
                                found.setdefault(t, []).append((a - int(first[t]), a - int(first[t]) + n, win.item[w]))
                n_words.extend(np.diff(first).tolist())
                for t in range(j - i):
                    flat, items = [], set()
                    for a, b, item in sorted(found.get(t, ())):
                        items.add(item)
                        if flat and a <= flat[-1]:
                            flat[-1] = max(flat[-1], b)
                        else:
                            flat += [a, b]
                    hit_spans.append(flat)
                    hit_items.append(sorted({win.ids[x] for x in items if win.ids[x] is not None}))
            return [n_words, hit_spans, hit_items]
        return run

    names = [f"{name}_{x}" for x in ("words", "spans", "items")]
    return map_text(docs, text, [field(names[0], "long"), field(names[1], "array<long>"), field(names[2], "array<string>")], make)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", *,
                  window: int = 10, block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``COLUMNS``; columns of those names in ``docs`` are replaced.

    ``n_words`` words of the whole text, ``n_hit`` of them inside any occurrence of any window, ``n_items`` items with
    occurring windows, their ids, sorted as strings, as ``item_ids`` and, comma-joined, as ``items_sha256``;
    ``contaminated`` is n_hit > 0.

    Null texts have no words and no windows.  Items that repeat an id count once; windows of an item with a null id hit,
    but the item is neither counted nor listed.  Repeated rows get equal results; empty tables are fine on either side.
    """
    ship(docs.sparkSession)
    items = benchmark.select(col(item_id).cast("string").alias("id"), col(item_text).cast("string").alias("t")).filter("t is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    names = [c for c in without(docs, COLUMNS) if carry is None or c in carry]
    d = docs.select(*[col(c).alias(f"__keep{i}") for i, c in enumerate(names)], col(text).cast("string").alias("__t"))
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b).collect()  # about block_bytes
        d = _search(d, "__t", Windows([r["id"] for r in part], [r["t"] for r in part], window), f"__b{b}")
        d = written(d) if b + 1 < blocks else d
    def pairs(name: str) -> Column:
        flat = F.col(name)
        return F.transform(F.filter(flat, lambda _, i: i % 2 == 0), lambda a, i: F.struct(a.alias("a"), F.get(flat, 2 * i + 1).alias("z")))

    spans = F.concat(*[pairs(f"__b{b}_spans") for b in range(blocks)])
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    hit = F.aggregate(F.sort_array(spans), start, lambda s, x: F.struct(
        F.greatest(s["end"], x["z"]).alias("end"), (s["n"] + F.greatest(x["z"] - F.greatest(x["a"], s["end"]), F.lit(0))).alias("n")),
        lambda s: s["n"])
    ids = F.sort_array(F.array_distinct(F.concat(*[F.col(f"__b{b}_items") for b in range(blocks)])))
    d = d.withColumns({"n_words": F.col("__b0_words"), "n_hit": hit, "item_ids": ids})
    d = d.withColumns({"n_items": F.size("item_ids").cast("long"), "items_sha256": F.sha2(F.array_join("item_ids", ","), 256),
                       "contaminated": F.col("n_hit") > 0})
    return d.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(names)], *COLUMNS)
