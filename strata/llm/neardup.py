"""Near-duplicate classes by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

1. Document frequencies count a large group of copies or near copies as about one document (``large_groups``), so that a
   group's own shingles aren't discounted for its size.  They are summed into a table of ``2**DF_BITS`` hashed cells,
   corrected for the mean load of a cell.  Its error is about the square root of that load, which
   an inverse document frequency (a logarithm) hardly feels; its size does not grow with the corpus.
2. Each text gets ``bands * rows`` consistent samples of its weighted shingles: two texts share a
   sample with the probability of their weighted Jaccard similarity.  ``rows`` samples make a band.
3. Equal texts are one node.  In each bucket of a band all nodes are compared with one hub, that which
   shares buckets with most nodes (of a group of edited copies, the original).  So a bucket of n nodes
   costs n comparisons, and no pair list of a group is ever made.
4. A comparison computes the weighted Jaccard similarity of the whole texts.  Nodes that their hub matches leave the
   bucket with it; the others get a new hub from among them, round by round, as long as a round links a fair part of its
   pairs (``WORTH``).  A round has at most one pair for each node that is left in a bucket.
5. Links of at least the threshold make connected components.  What the rounds left open is then settled exactly: where
   the nodes of a first bucket, its hub aside, lie in two components or more, a join over the signed differences from the
   hub (``_open_pairs``) gives every pair that may reach the threshold; the others are excluded by the weight of the
   differences that they can share at all.
   So two nodes that share a bucket of a band are linked if they are alike, whatever the rounds met.
6. The components of all links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import words as W
from strata.llm.common import col, field, map_text, ship, without, written

SHINGLE = 5
DF_BITS = 16
#: What fewer than this share of the documents have is rare.
RARE = 0.1
#: MinHash values of a text that tell large groups of near copies, how many of them must be a group's (of 0.8 alike texts 0.93 have so many, of
#: texts that share a third of their shingles 0.02), and the share of the rows from which on a group is large.
SKETCH, AGREE, LARGE = 12, 8, 0.001
#: Draws of the sampling tables, levels of a weight per doubling, their number, and the level of weight 1.
_DRAWS_BITS, _PER_OCTAVE, _LEVELS, _LOWEST = 14, 2, 48, 8
#: Another round follows one that linked at least this share of its pairs; what is left is settled exactly.
WORTH = 0.05
#: Sums of weights are rounded; bounds give way by this share.
_EPS = 1e-6


def _weighted(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: (first, end, distinct shingle hashes text by text, their counts, first shingle of each text)."""
    for i, j, data, off in W.chunks(texts):
        starts, ends, first = W.spans(data, off)
        sh, at = W.shingles(W.hashes(data, starts, ends), first, k)
        owner = np.repeat(np.arange(j - i), np.diff(at))
        order = np.lexsort((sh, owner))
        sh, owner = sh[order], owner[order]
        new = np.ones(len(sh), bool)
        new[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
        at_new = np.flatnonzero(new)
        yield i, j, sh[at_new], np.diff(np.append(at_new, len(sh))), np.searchsorted(owner[at_new], np.arange(j - i + 1))


def _least(texts: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts: whether each has a shingle, and for those that have the ``SKETCH`` least values of its hashed shingles (MinHash)."""
    odd = W.mix(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
    for _, _, data, off in W.chunks(texts):
        starts, ends, first = W.spans(data, off)
        sh, at = W.shingles(W.hashes(data, starts, ends), first, k)
        some = np.diff(at) > 0
        out = np.empty((int(some.sum()), SKETCH), np.uint64)
        for h in range(SKETCH if some.any() else 0):
            v = sh * odd[h]
            out[:, h] = np.minimum.reduceat(v ^ (v >> np.uint64(32)), at[:-1][some])
        yield some, out.view(np.int64)


def large_groups(docs: DataFrame, text: str = "text", k: int = SHINGLE) -> list[dict[int, int]]:
    """For each MinHash value of a sketch the values that a ``LARGE``-th of the rows or more have, with the number of rows: at most ``1 / LARGE`` each."""
    def run(batches):
        for b in batches:
            for _, least in _least(b.column(0).fill_null(""), k):
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(SKETCH, dtype=np.int32), len(least))), pa.array(least.ravel())], names=["h", "v"])

    part = docs.select(col(text).cast("string")).mapInArrow(run, "h int, v long").groupBy("h", "v").agg(F.count("*").alias("n"))
    part = written(part)
    rows = part.filter("h = 0").agg(F.sum("n")).first()[0] or 0
    found: list[dict[int, int]] = [{} for _ in range(SKETCH)]
    for r in part.filter(F.col("n") > max(1, LARGE * rows)).collect():  # at most SKETCH / LARGE rows
        found[r["h"]][r["v"]] = r["n"]
    return found


def document_frequencies(docs: DataFrame, text: str = "text", k: int = SHINGLE) -> tuple[int, np.ndarray]:
    """The number of documents with a shingle, and how many documents have a shingle in each hashed cell.

    A row counts as one part of its group: ``AGREE`` of the ``SKETCH`` MinHash values or more of a row are those of n rows or more, and it counts 1 / n.
    So exact and near copies of one text, if they are many, count as about one document; those that are a smaller part of the rows than
    ``LARGE`` count one by one, which no weight feels.
    Each task sums its own documents; the shuffle carries one row a task and block of cells.
    The result has a fixed size: ``2**DF_BITS`` numbers.
    """
    cells, block = 1 << DF_BITS, 1 << 12
    groups = docs.sparkSession.sparkContext.broadcast(large_groups(docs, text, k))

    def count(batches):
        df, n = np.zeros(cells), 0.0
        large = [(np.array(sorted(g), np.int64), np.array([g[v] for v in sorted(g)], np.float64)) for g in groups.value]
        for b in batches:
            texts = b.column(0).fill_null("") if b.column(0).null_count else b.column(0)
            for (_, _, sh, _, at), (some, least) in zip(_weighted(texts, k), _least(texts, k), strict=True):
                size = np.ones(least.shape)
                for h, (values, rows) in enumerate(large):
                    if len(values):
                        where = np.minimum(np.searchsorted(values, least[:, h]), len(values) - 1)
                        size[:, h] = np.where(values[where] == least[:, h], rows[where], 1)
                share = np.zeros(len(some))
                share[some] = 1 / np.sort(size, 1)[:, SKETCH - AGREE]
                df += np.bincount((sh >> np.uint64(64 - DF_BITS)).astype(np.int64), np.repeat(share, np.diff(at)), minlength=cells)
                n += float(share.sum())
        for i in range(0, cells, block):
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([df[i:i + block]], pa.list_(pa.float64())),
                                                  pa.array([n if not i else 0.0])], names=["cell", "df", "docs"])

    part = docs.select(col(text).cast("string")).mapInArrow(count, "cell long, df array<double>, docs double")
    # rounded, so that the order of the sums doesn't show
    rows = part.select("cell", "docs", F.posexplode("df").alias("at", "n")).groupBy((F.col("cell") + F.col("at")).alias("at")).agg(
        F.round(F.sum("n")).cast("long").alias("n"), F.round(F.sum(F.when(F.col("at") == 0, F.col("docs")))).cast("long").alias("docs"))
    got = rows.select("at", "n", "docs").toPandas()  # 2**DF_BITS rows
    df = np.zeros(cells, np.int64)
    if len(got):
        df[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return int(got["docs"].fillna(0).sum()) if len(got) else 0, df


def idf_table(docs: int, df: np.ndarray) -> np.ndarray:
    """Inverse document frequency by cell, log2(1 + documents / estimate).  The estimate is the cell's load above the mean; all that
    a share ``RARE`` of the documents have, or that the noise of a load hides (three times the square root of the mean), counts as rare.

    So boilerplate weighs less, but the shingles of a group of near copies, which counts as about one document, weigh as much as their edits.
    """
    mean = df.sum() / len(df)
    floor = max(1.0, RARE * docs, 3 * np.sqrt(mean))
    return np.log2(1 + max(docs, 1) / np.maximum(df - mean, floor))


class Sampler:
    """ICWS with tabulated draws: r, c ~ Gamma(2, 1) and beta ~ U(0, 1) of a shingle under a sample come from cell
    ``shingle * odd multiplier`` of one table, so that a weight level's ln(a) is a table look-up."""

    def __init__(self, n: int, idf: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        draws = 1 << _DRAWS_BITS
        r, c, beta = rng.gamma(2, 1, draws), rng.gamma(2, 1, draws), rng.uniform(0, 1, draws)
        level = ((np.arange(_LEVELS) - _LOWEST) / _PER_OCTAVE * np.log(2))[:, None]
        t = np.floor(level / r + beta)
        self.table = (np.log(c) - r * (t - beta) - r).astype(np.float32).ravel()
        self.odd = W.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2654435761) + np.uint64(seed)) | np.uint64(1)
        self.idf = idf

    def weights(self, sh: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return tf * self.idf[(sh >> np.uint64(64 - DF_BITS)).astype(np.int64)]

    def samples(self, sh: np.ndarray, weights: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each text with shingles (rows) and each sample the chosen shingle's hash; shingles come sorted by text and hash."""
        level = np.clip(np.rint(np.log2(np.maximum(weights, 1e-9)) * _PER_OCTAVE) + _LOWEST, 0, _LEVELS - 1)
        base = (level.astype(np.int64) << _DRAWS_BITS).astype(np.int64)
        some = np.flatnonzero(np.diff(at) > 0)
        begin, sizes = at[:-1][some], np.diff(at)[some]
        out = np.empty((len(some), len(self.odd)), np.uint64)
        place = np.arange(len(sh), dtype=np.int64)
        for h, odd in enumerate(self.odd):
            a = self.table[base + ((sh * odd) >> np.uint64(64 - _DRAWS_BITS)).astype(np.int64)]
            least = np.minimum.reduceat(a, begin)
            # of equal draws the shingle with the smallest hash: the first
            where = np.flatnonzero(a == np.repeat(least, sizes))
            _, first = np.unique(np.searchsorted(begin, place[where], "right"), return_index=True)
            out[:, h] = sh[where[first]]
        return out


    def band_keys(self, sh: np.ndarray, weights: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
        """For each text with shingles a key for each band of ``rows`` samples."""
        s = self.samples(sh, weights, at)
        s = s.reshape(len(s), -1, rows)
        mixed = np.zeros(s.shape[:2], np.uint64)
        for r in range(rows):
            mixed = W.mix(mixed + s[:, :, r] * np.uint64(0x9E3779B97F4A7C15))
        return mixed.view(np.int64)


def _node(text: str):
    """A text's hash: 128 bits of its SHA-256 (a null's as the empty text's)."""
    return F.substring(F.sha2(F.coalesce(col(text).cast("string"), F.lit("")), 256), 1, 32)


def signatures(docs: DataFrame, idf, text: str, k: int, bands: int, rows: int, carry: list[str]) -> DataFrame:
    """Columns ``carry`` with ``node`` (text's hash), ``n_shingles`` and ``band_keys`` (none without words)."""

    def make():
        sampler = Sampler(bands * rows, idf.value)

        def run(texts):
            keys, sizes = [], []
            for i, j, sh, tf, at in _weighted(texts, k):
                some = np.diff(at) > 0
                sizes.extend(np.diff(at).tolist())
                got = [None] * (j - i)
                if some.any():
                    mixed = sampler.band_keys(sh, sampler.weights(sh, tf), at, rows)
                    for t, key in zip(np.flatnonzero(some), mixed, strict=True):
                        got[t] = key
                keys.extend(x if x is not None else [] for x in got)
            return [pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
        return run

    named = docs.withColumn("node", _node(text))
    return map_text(named, text, [field("n_shingles", "long"), field("band_keys", "array<long>")], make, [*carry, "node"])


def _compared(pairs: DataFrame, idf, k: int, threshold: float) -> DataFrame:
    """Pairs ``node``, ``hub`` with their texts ``tn`` and ``th`` become ``link``: whether their weighted Jaccard similarity over the whole
    texts reaches the threshold."""
    def run(batches):
        sampler = Sampler(1, idf.value)
        held: dict[str, tuple] = {}

        def vectors(texts):
            """Weighted shingles of each text; the last hub's are held, as it mostly comes again."""
            todo = list(dict.fromkeys(x for x in texts if x not in held))
            fresh = dict(held)
            for i, j, sh, tf, at in _weighted(pa.array(todo, pa.string()), k):
                w = sampler.weights(sh, tf)
                for t in range(j - i):
                    fresh[todo[i + t]] = (sh[at[t]:at[t + 1]], w[at[t]:at[t + 1]])
            return [fresh[x] for x in texts]

        for b in batches:
            links = []
            for i in range(0, b.num_rows, 32):
                tn, th = (b.column(c).slice(i, 32).to_pylist() for c in (2, 3))
                vn, vh = vectors(tn), vectors(th)
                held.clear()
                held[th[-1]] = vh[-1]
                for (sa, wa), (sb, wb) in zip(vn, vh, strict=True):
                    sh, back = np.unique(np.concatenate([sa, sb]), return_inverse=True)
                    a, h = np.zeros(len(sh)), np.zeros(len(sh))
                    a[back[:len(sa)]], h[back[len(sa):]] = wa, wb
                    either = np.maximum(a, h).sum()
                    links.append(bool(either > 0 and np.minimum(a, h).sum() >= threshold * either))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(links, pa.bool_())], names=["node", "hub", "link"])

    return pairs.select("node", "hub", "tn", "th").mapInArrow(run, "node string, hub string, link boolean")


def _differences(pairs: DataFrame, idf, k: int, threshold: float) -> DataFrame:
    """Pairs ``node``, ``hub`` with ``root`` and texts ``tn`` and ``th`` become a row for each signed difference (``odd``: a shingle too many or too few, hashed
    with the hub): its weight ``size``, the node's ``cost`` and the hub's ``budget`` (the node matches it where cost <= budget)."""
    def run(batches):
        sampler = Sampler(1, idf.value)
        for b in batches:
            for i in range(0, b.num_rows, 32):  # a row for each difference would be too much of a whole batch
                part = b.slice(i, 32)
                tn, th = part.column(3).to_pylist(), part.column(4).to_pylist()
                todo, vec = list(dict.fromkeys(tn + th)), {}
                for x, _, sh, tf, at in _weighted(pa.array(todo, pa.string()), k):
                    w = sampler.weights(sh, tf)
                    for t in range(len(at) - 1):
                        vec[todo[x + t]] = (sh[at[t]:at[t + 1]], w[at[t]:at[t + 1]])
                odds, sizes, costs, budgets = [], [], [], []
                for h, (sa, wa), (sb, wb) in zip(part.column(1).to_pylist(), (vec[x] for x in tn), (vec[x] for x in th), strict=True):
                    sh, back = np.unique(np.concatenate([sa, sb]), return_inverse=True)
                    d = np.zeros(len(sh))
                    np.add.at(d, back, np.concatenate([wa, -wb]))
                    some = np.flatnonzero(d)
                    seed = np.uint64(int.from_bytes(h.encode()[:16], "little") % (1 << 64))
                    odds.append(W.mix(W.mix(sh[some] ^ np.where(d[some] > 0, np.uint64(0), np.uint64(0x5851F42D4C957F2D))) ^ seed).view(np.int64))
                    sizes.append(np.abs(d[some]))
                    costs.append(-d[d < 0].sum() + threshold * d[d > 0].sum())
                    budgets.append((1 - threshold) * wb.sum())
                of = pa.array(np.repeat(np.arange(len(odds)), [len(x) for x in odds]))
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(of) for c in (1, 0, 2)], pa.array(np.concatenate(odds)), pa.array(np.concatenate(sizes)),
                                                  pa.array(costs, pa.float64()).take(of), pa.array(budgets, pa.float64()).take(of)],
                                                 names=["hub", "node", "root", "odd", "size", "cost", "budget"])

    return pairs.select("node", "hub", "root", "tn", "th").mapInArrow(
        run, "hub string, node string, root string, odd long, size double, cost double, budget double")


def _open_pairs(member: DataFrame, label: DataFrame, texts: DataFrame, idf, k: int, threshold: float) -> DataFrame:
    """Pairs ``node``, ``hub`` of different components that share a bucket (and so its hub) and may reach the threshold; ``member`` has ``bucket``,
    ``node`` and ``hub``.  Pairs with the hub itself were compared in the first round.

    Let H be the hub's weight, and a node's cost what it lacks of it plus threshold times what it has besides.  Two nodes a and b that share differences of
    weight S reach the threshold where (1 + threshold) S >= cost(a) + cost(b) - (1 - threshold) H.  Only differences that nodes of two components have
    can be shared, so S is at most their weight (``left``) from the first on that both share, in a fixed order, the rarest first.  At least one of two
    nodes of different components doesn't match the hub; so a node's own cost bounds what it must have left.
    """
    others = member.filter("node <> hub").join(label, "node").select("bucket", "node", "hub", "root")
    crowd = others.groupBy("bucket").agg((F.min("root") < F.max("root")).alias("open")).filter("open")
    pairs = written(others.join(crowd, "bucket", "left_semi").select("node", "hub", "root").distinct())
    both = pairs.join(texts.select("node", F.col("t").alias("tn")), "node").join(texts.select(F.col("node").alias("hub"), F.col("t").alias("th")), "hub")
    # hashes instead of names: those of pairs that fall together make pairs to compare too many, none too few
    name = F.xxhash64("hub", "node").alias("pair")
    part = written(_differences(both, idf, k, threshold)).select(name, F.xxhash64("root").alias("root"), "odd", "size", "cost", "budget")
    # a difference that only one component has makes no pair and can't be shared
    shared = part.groupBy("odd").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n")).filter("r0 < r1").select("odd", "n")
    rest = Window.partitionBy("pair").orderBy(F.desc("n"), F.desc("odd")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = part.join(shared, "odd").withColumn("left", F.sum("size").over(rest) * (1 + _EPS))
    # a node that doesn't match needs its excess shared at least, one that does the part that its own cost asks for
    part = written(part.filter(F.col("left") >= F.when(F.col("cost") > F.col("budget"), F.col("cost") - F.col("budget")).otherwise(F.col("cost") / (1 + threshold))))
    a = part.filter("cost > budget")
    b = part.select("odd", *[F.col(c).alias(f"{c}2") for c in ("pair", "root", "left", "cost")])
    need = (F.col("cost") + F.col("cost2") - F.col("budget")) / (1 + threshold)
    once = (F.col("cost2") <= F.col("budget")) | (F.col("pair") <= F.col("pair2"))  # of two nodes that both don't match the hub from one side only
    met = a.join(b, "odd").filter((F.col("root") != F.col("root2")) & once & (F.least("left", "left2") >= need)).select("pair", "pair2").distinct()
    names = pairs.select(name, F.col("node").alias("x"))
    met = met.join(names, "pair").join(names.select(F.col("pair").alias("pair2"), F.col("x").alias("y")), "pair2").filter("x <> y")
    return met.select(F.least("x", "y").alias("node"), F.greatest("x", "y").alias("hub")).distinct()


def _spread(label: DataFrame, both: DataFrame) -> DataFrame:
    """``label`` (``node``, ``root``) after each node took the least root of its neighbours in ``both`` (``x``, ``y``), and that root's own root;
    ``was`` is the root before.  Joins and grouped minima only."""
    near = both.join(label, F.col("y") == F.col("node")).groupBy("x").agg(F.min("root").alias("near"))
    step = label.join(near, F.col("node") == F.col("x"), "left").select(
        "node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
    jump = step.select(F.col("node").alias("mid"), F.col("root").alias("far"))
    return written(step.join(jump, F.col("root") == F.col("mid"), "left").select(
        "node", F.least("root", "far").alias("root"), "was"))


def components(label: DataFrame, links: DataFrame) -> DataFrame:
    """``node`` and ``root``, one for each connected component; ``label`` may already be on the way there."""
    both = written(links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y"))))
    while True:
        label = _spread(label.select("node", "root"), both)
        if label.filter("root <> was").isEmpty():
            return label.select("node", "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, threshold: float = 0.8, k: int = SHINGLE,
                    bands: int = 20, rows: int = 5, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (default: ``doc_id``) of every row of ``docs`` with ``node`` (the text's hash), ``class_key`` (the least node of the class), ``class_id`` (the least
    doc_id of the class), ``class_size`` (rows) and ``n_links`` (verified links of its text to other texts).

    Two texts whose weighted Jaccard similarity over TF-IDF shingles of ``k`` words is s become candidates with
    probability 1 - (1 - s**rows)**bands (0.9996 at 0.8).  Texts of fewer words, but not none, are one shingle.
    Equal texts are always one class.  Null and word-less texts are like no other text: only equal ones share a class,
    and nulls count as the empty text.  Null ids: ``class_id`` is null where all ids of the class are.  Repeated rows stay, each with its class.
    """
    spark = docs.sparkSession
    ship(spark)
    carry = [doc_id] if carry is None else carry
    n, df = document_frequencies(docs, text, k)
    idf = spark.sparkContext.broadcast(idf_table(n, df))  # 2**DF_BITS numbers
    sig = written(signatures(docs, idf, text, k, bands, rows, without(docs.select(*[col(c) for c in carry]), ["node", "n_shingles", "band_keys"])))
    nodes = sig.groupBy("node").agg(F.max(F.struct("n_shingles", "band_keys")).alias("s"), F.min(doc_id).alias("least"), F.count("*").alias("size"))
    nodes = written(nodes.select("node", "least", "size", F.col("s.band_keys").alias("band_keys")))
    links, root = _links(docs, nodes, idf, doc_id, text, k, threshold)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    member = written(nodes.drop("band_keys").join(root, "node", "left").join(degree, "node", "left").select(
        "node", "least", "size", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    classes = member.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("size").alias("class_size"))
    named = member.join(classes, "root").select("node", F.col("root").alias("class_key"), "class_id", "class_size", "n_links")
    kept = [c for c in sig.columns if c not in ("n_shingles", "band_keys", "node")]
    kept = without(sig.select(*[col(c) for c in kept]), ["class_key", "class_id", "class_size", "n_links"])
    return sig.select(*[col(c) for c in kept], "node").join(named, "node").select(
        *[col(c) for c in kept], "node", "class_key", "class_id", "class_size", "n_links")


def _links(docs: DataFrame, nodes: DataFrame, idf, doc_id: str, text: str, k: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Verified links ``a``, ``b`` between texts, and the component (``root``) of each ``node`` that was compared.

    In the rounds a node that its hub matches leaves the bucket, as does the hub; what is like it, yet not its hub, is found when the rounds are over.
    """
    slots = nodes.select("node", F.posexplode("band_keys").alias("band", "key"))
    slots = slots.select("node", F.xxhash64("band", "key").alias("bucket"))
    crowd = slots.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    slots = written(slots.join(crowd, "bucket"))
    # how many nodes a node meets in all its buckets
    central = written(slots.groupBy("node").agg(F.sum("n").alias("meets")))
    # one row's text for each node: the id beside the hash keeps the copies of a text apart in the shuffle
    wanted = central.select("node").join(nodes.select("node", F.col("least").alias("__least")), "node")
    texts = docs.select(col(doc_id).alias("__id"), _node(text).alias("__n"), col(text).cast("string").alias("t"))
    texts = texts.join(wanted, (F.col("__n") == F.col("node")) & F.col("__id").eqNullSafe(F.col("__least")))
    texts = written(texts.groupBy("node").agg(F.first("t").alias("t")))
    links, seen, first = [], None, None
    member = slots.join(central, "node")
    while True:
        hubs = member.groupBy("bucket").agg(F.max_by("node", F.struct("meets", "node")).alias("hub"), F.count("*").alias("n")).filter("n > 1")
        member = written(member.join(hubs, "bucket").select("bucket", "node", "meets", "hub"))
        first = member if first is None else first
        pairs = member.filter("node <> hub").select("node", "hub").distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["node", "hub"], "left_anti")
        pairs = written(pairs)
        if pairs.isEmpty():
            break
        both = pairs.join(texts.select("node", F.col("t").alias("tn")), "node").join(texts.select(F.col("node").alias("hub"), F.col("t").alias("th")), "hub")
        met = written(_compared(both, idf, k, threshold))
        links.append(met.filter("link").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
        met = met.unionByName(met.select(F.col("hub").alias("node"), F.col("node").alias("hub"), "link"))
        seen = met if seen is None else seen.unionByName(met)
        if met.agg(F.count_if("link") < WORTH * F.count("*")).first()[0]:
            break
        member = member.filter("node <> hub").join(seen.filter("link"), ["node", "hub"], "left_anti").select("bucket", "node", "meets")
    found = pairs.limit(0).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    for part in links:
        found = found.unionByName(part)
    found = written(found.distinct())
    label = components(central.select("node", F.col("node").alias("root")), found)
    more = written(_open_pairs(first, label, texts, idf, k, threshold).join(seen, ["node", "hub"], "left_anti")) if seen is not None else pairs
    if more.isEmpty():
        return found, label
    both = more.join(texts.select("node", F.col("t").alias("tn")), "node").join(texts.select(F.col("node").alias("hub"), F.col("t").alias("th")), "hub")
    late = _compared(both, idf, k, threshold).filter("link").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    found = written(found.unionByName(late))
    return found, components(label, found)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that of the least doc_id (nulls last), and of equal ids of the least text hash.

    Rows equal in both are taken as one.
    """
    found = near_duplicates(docs, doc_id, text, carry=[doc_id], **options)
    first = F.struct(col(doc_id).isNull(), col(doc_id), F.col("node"))
    keep = found.groupBy("class_key").agg(F.min(first).alias("k")).select(
        F.col(f"k.{doc_id}").alias("__id"), F.col("k.node").alias("__node"))
    rows = docs.withColumn("__node_of", _node(text))
    kept = rows.join(keep, (F.col("__node_of") == F.col("__node")) & col(doc_id).eqNullSafe(F.col("__id")), "left_semi")
    others = [c for c in docs.columns if c != doc_id]
    return kept.groupBy("__node_of", doc_id).agg(F.first(F.struct(*[col(c) for c in others])).alias("__row")).select(
        *[col(c) if c == doc_id else F.col("__row").getField(c).alias(c) for c in docs.columns])
