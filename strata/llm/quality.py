"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: round after round each feature in turn gets one shallow tree over its bins, added with a small rate to
the feature's lookup table; then the pairs of features that explain most of what is left get two-dimensional tables in the
same way.  A text's score is the sum of its bins' entries, squashed to 0..1.
"""

from __future__ import annotations

from dataclasses import dataclass, field as default

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import words as W
from strata.llm.common import col, field, map_text, ship, without

COLUMNS = ["score", "predicted"]
#: At most so many labelled rows are used to fit the model.
MAX_ROWS = 20_000
FEATURES = ["log_words", "upper", "digit", "space", "newline", "exclamation", "pipe", "symbol", "punctuation", "non_ascii",
            "word_length", "short_words", "long_words", "distinct_words", "top_word", "repeated_trigrams", "words_per_line"]
# Byte classes of the character features.
_BYTES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t", "newline": b"\n", "exclamation": b"!",
          "pipe": b"|", "symbol": b"#*$%&<>@^~_=+{}[]\\/", "punctuation": b".,;:?'\"()-", "non_ascii": bytes(range(0xC0, 0x100))}
_CLASS = np.zeros(256, np.uint8)
for _n, _members in enumerate(_BYTES.values(), 1):
    _CLASS[list(_members)] = _n


def features_of(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text, all from its whole text; an empty text has zeros."""
    rows = []
    for i, j, data, off in W.chunks(texts):
        n, size = j - i, np.maximum(np.diff(off), 1)
        out = np.zeros((n, len(FEATURES)))
        kind = _CLASS[data]
        for c in range(1, len(_BYTES) + 1):
            upto = np.concatenate(([0], np.cumsum(kind == c)))
            out[:, c] = (upto[off[1:]] - upto[off[:-1]]) / size
        starts, ends, first = W.spans(data, off)
        h, long = W.hashes(data, starts, ends), ends - starts
        count = np.diff(first)
        some = np.maximum(count, 1)
        out[:, 0] = np.log1p(count)
        for c, v in ((10, long), (11, long <= 3), (12, long > 20)):
            upto = np.concatenate(([0], np.cumsum(v)))
            out[:, c] = (upto[first[1:]] - upto[first[:-1]]) / some
        sh, at = W.shingles(h, first, 3)
        for t in np.flatnonzero(count):
            _, times = np.unique(h[first[t]:first[t + 1]], return_counts=True)
            out[t, 13], out[t, 14] = len(times) / count[t], times.max() / count[t]
            out[t, 15] = 1 - len(np.unique(sh[at[t]:at[t + 1]])) / (at[t + 1] - at[t])
        out[:, 16] = np.log1p(count / (1 + out[:, 4] * size))
        rows.append(out)
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


@dataclass
class Model:
    """Bin edges and table of each feature, tables of pairs over coarse bins, and the constant."""

    constant: float
    edges: list = default(default_factory=list)
    tables: list = default(default_factory=list)
    coarse: list = default(default_factory=list)
    pairs: list = default(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.constant)
        for k, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, k], "right")]
        for a, b, t in self.pairs:
            z += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-z))


def _shallow(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> tuple[np.ndarray, float]:
    """A tree over ordered bins with gradient and curvature sums: each bin's leaf value, and the gain."""
    def gain(a, b):
        return a * a / (b + ridge)
    parts, total = [(0, len(g))], 0.0
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for k, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
            v = gain(cg[:-1], ch[:-1]) + gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - gain(cg[-1], ch[-1])
            at = int(np.argmax(v))
            if v[at] > best[0]:
                best = (float(v[at]), (k, lo + at + 1))
        if best[1] is None:
            break
        k, cut = best[1]
        lo, hi = parts.pop(k)
        parts += [(lo, cut), (cut, hi)]
        total += best[0]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out, total


def _square(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """A tree over a grid: one cut of the rows, and one of the columns on each side of it."""
    best = (np.zeros(g.shape), 0.0)
    for cut in range(1, g.shape[0]):
        out, total = np.zeros(g.shape), 0.0
        for rows in (slice(0, cut), slice(cut, None)):
            v, gain = _shallow(g[rows].sum(0), h[rows].sum(0), 2, ridge)
            out[rows] = v
            total += gain
        if total > best[1]:
            best = (out, total)
    return best


def fit(x: np.ndarray, y: np.ndarray, *, bins: int = 32, coarse_bins: int = 8, rounds: int = 150, pair_rounds: int = 40, pairs: int = 6,
        rate: float = 0.2, leaves: int = 3, ridge: float = 2.0) -> Model:
    """The model of labels 0/1.  No rows: the constant 0 (score 0.5); one label only: its smoothed share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    m = Model(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return m
    def cuts(k, n):
        return np.unique(np.quantile(x[:, k], np.linspace(0, 1, n + 1)[1:-1], method="inverted_cdf"))
    d = x.shape[1]
    m.edges, m.coarse = [cuts(k, bins) for k in range(d)], [cuts(k, coarse_bins) for k in range(d)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    at = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(m.edges)]
    z = np.full(len(y), m.constant)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, np.maximum(p * (1 - p), 1e-6)
    for _ in range(rounds):
        for k in range(d):
            g, h = slopes()
            n = len(m.tables[k])
            step = rate * _shallow(np.bincount(at[k], g, n), np.bincount(at[k], h, n), leaves, ridge)[0]
            m.tables[k] += step
            z += step[at[k]]
    rough = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(m.coarse)]
    def grid(a, b, v):
        nb = len(m.coarse[b]) + 1
        return np.bincount(rough[a] * nb + rough[b], v, (len(m.coarse[a]) + 1) * nb).reshape(-1, nb)
    g, h = slopes()
    gains = sorted(((_square(grid(a, b, g), grid(a, b, h), ridge)[1], a, b) for a in range(d) for b in range(a + 1, d)), reverse=True)
    m.pairs = [(a, b, np.zeros((len(m.coarse[a]) + 1, len(m.coarse[b]) + 1))) for gain, a, b in gains[:pairs] if gain > 0]
    for _ in range(pair_rounds):
        for a, b, t in m.pairs:
            g, h = slopes()
            step = rate * _square(grid(a, b, g), grid(a, b, h), ridge)[0]
            t += step
            z += step[rough[a], rough[b]]
    return m


def quality_features(docs: DataFrame, text: str = "text", *, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``features``, an array in the order of FEATURES."""
    def make():
        return lambda texts: [pa.array(list(features_of(texts)), pa.list_(pa.float64()))]
    return map_text(docs, text, [field("features", "array<double>")], make, carry)


def fit_quality(found: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", *, max_rows: int = MAX_ROWS, seed: int = 0) -> Model:
    """The model of the labelled rows of ``found`` (``quality_features``), of at most ``max_rows`` of them: those of the least id hash.

    Rows whose label is null, and ids that have no document, don't count; an id with several labels gives a row for each.
    """
    rows = found.select(col(doc_id).alias("i"), "features").join(labels.select(col(doc_id).alias("j"), col(label).alias("y")).filter("y in (0, 1)"),
                                                                F.col("i") == F.col("j"))
    n = rows.count()
    u = F.pmod(F.xxhash64("i", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = rows.filter(u < min(1.0, 1.1 * max_rows / max(n, 1)))  # so that no task sends many more rows than are taken
    got = rows.select("i", "features", "y").orderBy(u, "i", "y").limit(max_rows).collect()
    return fit(np.array([r["features"] for r in got]).reshape(len(got), len(FEATURES)), np.array([r["y"] for r in got], float))


def score_quality(found: DataFrame, model: Model, *, threshold: float = 0.7) -> DataFrame:
    """The columns of ``found`` but ``features``, with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    A null or empty text has zero features and their score.  Repeated rows get equal scores; an empty table gives an empty result.
    """
    ship(found.sparkSession)
    shared = found.sparkSession.sparkContext.broadcast(model)  # tables of a few hundred bins a feature
    kept = without(found, [*COLUMNS, "features"])
    src = found.select(*[col(c) for c in kept], "features")
    schema = T.StructType([src.schema[c] for c in kept] + [field("score", "double"), field("predicted", "int")])

    def run(batches):
        for b in batches:
            x = b.column(b.num_columns - 1)
            s = shared.value.score(np.asarray(x.flatten(), float).reshape(b.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return src.mapInArrow(run, schema)
