"""Language of texts, and spans of languages in mixed texts.

A word's script narrows the languages it can be of.  Its score for each of them is the sum of log likelihoods
of its byte trigrams, and of the whole word if it is known.  Viterbi over a text's words, with a
penalty for each switch, labels the words; the language of most letters is the text's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import col, field, map_text, ship

UNKNOWN = "und"
COLUMNS = ["lang_pred", "score", "span_langs", "span_words"]
#: About so many texts of each language are learned from, drawn by a hash of the id.
TEXTS_PER_LANGUAGE = 2_000
_BITS = 15
_CELLS = 1 << _BITS
# The first two UTF-8 bytes of letters by script (first byte from, to; second byte from, to).
_SCRIPTS = {
    "latin": [(0x61, 0x7A, 0, 255), (0xC3, 0xCA, 0x80, 0xBF), (0xE1, 0xE1, 0xB8, 0xBB)],
    "greek": [(0xCD, 0xCD, 0xB0, 0xBF), (0xCE, 0xCF, 0x80, 0xBF), (0xE1, 0xE1, 0xBC, 0xBF)],
    "cyrillic": [(0xD0, 0xD4, 0x80, 0xBF)], "armenian": [(0xD5, 0xD5, 0x80, 0xBF)], "hebrew": [(0xD6, 0xD7, 0x90, 0xBF)],
    "arabic": [(0xD8, 0xDB, 0x80, 0xBF)], "devanagari": [(0xE0, 0xE0, 0xA4, 0xA5)], "bengali": [(0xE0, 0xE0, 0xA6, 0xA7)],
    "gurmukhi_gujarati": [(0xE0, 0xE0, 0xA8, 0xAB)], "tamil": [(0xE0, 0xE0, 0xAE, 0xAF)], "telugu_kannada": [(0xE0, 0xE0, 0xB0, 0xB3)],
    "malayalam": [(0xE0, 0xE0, 0xB4, 0xB5)], "thai_lao": [(0xE0, 0xE0, 0xB8, 0xBB)], "georgian": [(0xE1, 0xE1, 0x82, 0x83)],
    "kana": [(0xE3, 0xE3, 0x81, 0x83)], "han": [(0xE3, 0xE3, 0x90, 0xBF), (0xE4, 0xE9, 0x80, 0xBF)],
    "hangul": [(0xEA, 0xEA, 0xB0, 0xBF), (0xEB, 0xED, 0x80, 0xBF)],
}
_SCRIPT = np.zeros((256, 256), np.uint8)
for _n, _ranges in enumerate(_SCRIPTS.values(), 1):
    for _a, _b, _c, _d in _ranges:
        _SCRIPT[_a:_b + 1, _c:_d + 1] = _n
_LETTER = ((W.LOWER >= 0x61) & (W.LOWER <= 0x7A)) | (W.LOWER >= 0x80)


def _cells(data: np.ndarray, off: np.ndarray):
    """Trigram cell of each byte (``_CELLS`` where it is no letter), the words' starts, cells, scripts and letters, and each text's first word."""
    starts, ends, first = W.spans(data, off)
    x = np.where(W.IS_WORD[data], W.LOWER[data], 32).astype(np.uint32)
    before, after = np.roll(x, 1), np.roll(x, -1)
    edge = off[:-1][off[:-1] < len(data)]
    before[edge] = 32
    after[off[1:][off[1:] > 0] - 1] = 32
    tri = (((before << 16) | (x << 8) | after) * np.uint32(2654435761)) >> np.uint32(32 - _BITS)
    letter = _LETTER[data]
    tri = np.where(letter, tri, _CELLS).astype(np.int64)
    word = (W.hashes(data, starts, ends) >> np.uint64(64 - _BITS)).astype(np.int64)
    second = data[np.minimum(starts + 1, max(len(data) - 1, 0))] if len(data) else starts
    script = _SCRIPT[W.LOWER[data[starts]], second] if len(data) else np.zeros(0, np.uint8)
    upto = np.concatenate(([0], np.cumsum(letter)))
    return tri, starts, word, script, upto[ends] - upto[starts], first


class Model:
    """Tables of scores by trigram and word cell, and which languages are written in which script."""

    def __init__(self, langs: list[str], tri: np.ndarray, word: np.ndarray, script: np.ndarray, docs: np.ndarray):
        self.langs = langs
        n = len(langs)
        def table(c):
            if not n:
                return np.zeros((len(c) + 1, 0), np.float32)
            p = np.log((c + 0.5) / (c.sum(0) + 0.5 * len(c)))
            p -= p.mean(1, keepdims=True)
            p[c.sum(1) == 0] = 0  # nothing known: no word for or against
            return np.vstack([p, np.zeros((1, n))]).astype(np.float32)
        self.tri, self.word = table(tri), table(word)
        self.allowed = np.asarray(script / np.maximum(script.sum(0), 1) >= 0.005)
        self.allowed[0] = True
        self.allowed[~self.allowed.any(1)] = True
        self.prior = int(np.argmax(docs)) if len(langs) else -1
        self.barred = np.where(self.allowed, 0, -50).astype(np.float32)

    def word_scores(self, tri, starts, word, script, letters) -> np.ndarray:
        if not len(starts) or not self.langs:
            return np.zeros((len(starts), len(self.langs)), np.float32)
        s = np.add.reduceat(self.tri[tri], starts, axis=0) + self.word[word]
        s = np.clip(s, -8, 8) + self.barred[script]
        s[letters == 0] = 0
        return s


def viterbi(s: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word, where each change of language costs ``switch``.

    If no other language gains more than half a switch over the best single one on any run of words,
    no path with a switch can win, and the single one is the answer.
    """
    base = int(np.argmax(s.sum(0, dtype=np.float64)))
    gain = np.cumsum(s - s[:, base:base + 1], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, s.shape[1])), gain[:-1]]), axis=0)
    if (gain - low).max() <= switch / 2:
        return np.full(len(s), base)
    n, back = len(s), np.zeros(s.shape, bool)
    came, v = np.zeros(n, np.int64), s[0].astype(np.float64)
    for t in range(1, n):
        top = int(v.argmax())
        came[t] = top
        back[t] = v < v[top] - switch
        v = np.maximum(v, v[top] - switch) + s[t]
    out = np.empty(n, np.int64)
    at = int(v.argmax())
    for t in range(n - 1, -1, -1):
        out[t] = at
        if back[t, at]:
            at = int(came[t])
    return out


def fit_language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", *,
                 per_language: int = TEXTS_PER_LANGUAGE, seed: int = 0) -> Model:
    """Learns from about ``per_language`` texts of each non-null language; only counts by cell and language reach the driver."""
    ship(docs.sparkSession)
    d = docs.select(col(doc_id).alias("i"), col(text).cast("string").alias("t"), col(lang).cast("string").alias("l")).filter("l is not null and t is not null")
    docs_of = {r["l"]: r["n"] for r in d.groupBy("l").agg(F.count("*").alias("n")).collect()}  # a row a language
    langs = sorted(docs_of)
    if not langs:
        return Model([], np.zeros((_CELLS, 0)), np.zeros((_CELLS, 0)), np.zeros((len(_SCRIPTS) + 1, 0)), np.zeros(0))
    share = F.create_map(*[x for l in langs for x in (F.lit(l), F.lit(min(1.0, per_language / docs_of[l])))])
    u = F.pmod(F.xxhash64("i", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    number = {l: n for n, l in enumerate(langs)}

    def count(batches):
        kinds = {k: np.zeros((len(langs), n), np.int64) for k, n in (("tri", _CELLS + 1), ("word", _CELLS), ("script", len(_SCRIPTS) + 1))}
        for b in batches:
            which = np.array([number[x] for x in b.column(1).to_pylist()], np.int64)
            for i, j, data, off in W.chunks(b.column(0)):
                tri, starts, word, script, letters, first = _cells(data, off)
                for t in range(j - i):
                    l, w = which[i + t], slice(first[t], first[t + 1])
                    kinds["tri"][l] += np.bincount(tri[off[t]:off[t + 1]], minlength=_CELLS + 1)
                    kinds["word"][l] += np.bincount(word[w][letters[w] > 0], minlength=_CELLS)
                    kinds["script"][l] += np.bincount(script[w][letters[w] > 0], minlength=len(_SCRIPTS) + 1)
        for k, c in kinds.items():
            l, cell = np.nonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(l), pa.string()), pa.array(l.astype(np.int64)), pa.array(cell.astype(np.int64)),
                                              pa.array(c[l, cell])], names=["kind", "l", "cell", "n"])

    rows = d.filter(u < F.element_at(share, F.col("l"))).select("t", "l").mapInArrow(count, "kind string, l long, cell long, n long")
    got = rows.groupBy("kind", "l", "cell").agg(F.sum("n").alias("n")).toPandas()  # cells by languages
    def counts(kind, n):
        g, out = got[got["kind"] == kind], np.zeros((n, len(langs)))
        out[g["cell"].to_numpy(np.int64), g["l"].to_numpy(np.int64)] = g["n"].to_numpy(float)
        return out
    return Model(langs, counts("tri", _CELLS + 1)[:_CELLS], counts("word", _CELLS), counts("script", len(_SCRIPTS) + 1),
                 np.array([docs_of[l] for l in langs], float))


def detect_language(docs: DataFrame, model: Model, text: str = "text", *, switch: float = 12.0, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``lang_pred``, ``score`` (share of the letters that are in spans of it) and the spans: ``span_langs`` and
    the number of words of each, ``span_words``.  Such columns in ``docs`` are replaced.

    A null text, or one without a letter, is ``und`` with score 0 and no spans; so is all if no language was learned.  Letters of which nothing is known
    get the most frequent language with score 0.  Repeated rows get equal results; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 * 2**15 numbers a language

    def make():
        m = shared.value

        def one(s, letters, raw):
            total = int(letters.sum())
            if not total or not m.langs or not (_ASCII_LETTER[raw].any() or any(map(str.isalpha, raw.tobytes().decode("utf-8", "replace")))):
                return UNKNOWN, 0.0, [], []
            if not s.any():
                return m.langs[m.prior], 0.0, [m.langs[m.prior]], [len(s)]
            label = viterbi(s, switch)
            by = np.bincount(label, letters, len(m.langs))
            best = int(by.argmax())
            change = np.concatenate(([0], np.flatnonzero(np.diff(label)) + 1, [len(label)]))
            return m.langs[best], float(by[best] / total), [m.langs[label[c]] for c in change[:-1]], np.diff(change).tolist()

        def run(texts):
            out = []
            for i, j, data, off in W.chunks(texts, max(1 << 16, (1 << 22) // max(len(m.langs), 4))):
                tri, starts, word, script, letters, first = _cells(data, off)
                s = m.word_scores(tri, starts, word, script, letters)
                for t in range(j - i):
                    w = slice(first[t], first[t + 1])
                    out.append(one(s[w], letters[w], data[off[t]:off[t + 1]]))
            return [list(c) for c in zip(*out, strict=True)]
        return run

    return map_text(docs, text, [field("lang_pred", "string"), field("score", "double"), field("span_langs", "array<string>"),
                                 field("span_words", "array<long>")], make, carry)


_ASCII_LETTER = (W.LOWER >= 0x61) & (W.LOWER <= 0x7A)
