"""Ranked lexical search by the Best Position Algorithm over impact lists of blocks of documents.

One pass counts the searched terms of every text and writes them as an index, from which the collection's figures come.
The index is then read in blocks of documents.  Within a block each term's list holds its documents by falling impact.
An item's lists are read from their best positions on: the position up to which every entry of a list has been seen,
whether read there or met by a direct access from another list.  Each document that comes up is looked up in all lists,
which gives its whole score and marks its places in them as seen, so that best positions move past entries that were
never read in turn.  The impacts at the first unseen positions add up to the most that an unseen document can score; the
search of a block ends when that is strictly below the kth score found so far (equal scores may still win by their id).
A task keeps its k best for each item from block to block; the last step ranks k rows a task and item.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import col, field, map_text, pa_type, ship, written

COLUMNS = ["item_id", "rank", "doc_id", "score"]
#: Bytes of item text that are searched for at once; entries and documents of a block of the index.
ITEM_BYTES, POSTINGS, DOCUMENTS = 8 << 20, 1 << 21, 1 << 20
_PIECE = 1 << 20
_AS_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def term_counts(text: bytes, vocabulary: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """The number of terms of a text, and the occurrences of those in ``vocabulary``; read in pieces that end between terms."""
    text = text.translate(_AS_WORDS)
    n, found, at = 0, {}, 0
    while at < len(text):
        end = text.find(b" ", at + _PIECE)
        words = text[at:end if end >= 0 else len(text)].split()
        n += len(words)
        counts = Counter(words)
        for w in counts.keys() & vocabulary.keys():
            i = vocabulary[w]
            found[i] = found.get(i, 0) + counts[w]
        at = end if end >= 0 else len(text)
    return n, found


def terms_of(text: str | None) -> set[bytes]:
    return set((text or "").encode().translate(_AS_WORDS).split())


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """The impact lists of a block of documents, and the same entries by document for direct accesses."""

    def __init__(self, rank: np.ndarray, n: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, n_terms: int):
        """``rank``: each document's place by id; ``counts`` entries of (``terms``, ``tfs``) belong to each."""
        if 90 * int(n.max(initial=0)) * n_docs < 1 << 63:
            m = 10 + (90 * n * n_docs) // n_terms
        else:
            m = np.array([10 + 90 * x * n_docs // n_terms for x in n.tolist()], np.int64)
        doc, tfs = np.repeat(rank, counts), tfs.astype(np.int64)
        impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, counts))  # at most 1,000,000
        terms = terms.astype(np.int64)
        order = np.argsort((terms << 40) | ((1_000_000 - impact) << 20) | doc)  # by term, falling impact, id
        self.doc, self.impact = doc[order], impact[order]
        by_doc = np.argsort((terms[order] << 20) | self.doc)
        self.sorted_doc, self.place = self.doc[by_doc], by_doc
        self.vocabulary, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(order))
        self.size = len(rank)

    def lists(self, terms: np.ndarray, weights: np.ndarray) -> list:
        """(weight, documents and impacts by impact, documents by id and their positions) of each of the terms here."""
        out = []
        for i in np.flatnonzero(np.isin(terms, self.vocabulary, assume_unique=True)).tolist():
            j = int(np.searchsorted(self.vocabulary, terms[i]))
            a, z = int(self.first[j]), int(self.first[j + 1])
            out.append((int(weights[i]), self.doc[a:z], self.impact[a:z], self.sorted_doc[a:z], self.place[a:z] - a))
        return out


def best_positions(lists: list, k: int, floor: int = 0, step: int = 32) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, documents scored) of the ``k`` best by (score, least document), without those that
    ``floor``, the kth score known from elsewhere, rules out."""
    docs = scores = np.zeros(0, np.int64)
    seen = [np.zeros(len(x[1]) + 1, bool) for x in lists]  # one more, never seen
    best = [0] * len(lists)
    scored = 0
    while True:
        bound = sum(w * int(q[b]) for (w, _, q, _, _), b in zip(lists, best, strict=True) if b < len(q))
        kth = max(floor, int(scores[k - 1]) if len(scores) == k else 0)
        if bound == 0 or bound < kth:
            return docs, scores, scored
        # a document not seen in one list has been seen in none
        new = np.unique(np.concatenate([d[b:b + step][~s[b:b + step][:len(d) - b]] for (_, d, *_), s, b in zip(lists, seen, best, strict=True)]))
        total = np.zeros(len(new), np.int64)
        for i, (w, _, q, by_doc, place) in enumerate(lists):
            at = np.searchsorted(by_doc, new)
            hit = np.flatnonzero(by_doc[np.minimum(at, len(by_doc) - 1)] == new)
            where = place[at[hit]]
            total[hit] += w * q[where]
            seen[i][where] = True
            best[i] += int(np.argmin(seen[i][best[i]:]))
        scored += len(new)
        docs, scores = np.concatenate([docs, new]), np.concatenate([scores, total])
        top = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[top], scores[top]
        step *= 2


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(key, n, terms, tfs) of the documents that have a term: all their terms counted, those of ``vocabulary`` listed."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        words = shared.value

        def run(texts):
            found = [term_counts(t, words) for t in pc.cast(texts, pa.binary()).to_pylist()]
            return [[n for n, _ in found], [list(x) for _, x in found], [list(x.values()) for _, x in found]]
        return run

    return written(map_text(docs, "text", [field("n", "long"), field("terms", "array<int>"), field("tfs", "array<int>")], make).filter("n > 0"))


def _ranked(index: DataFrame, ids: list, wanted: list[np.ndarray], id_type: T.DataType, k: int, n_docs: int, n_terms: int, weights: np.ndarray) -> DataFrame:
    """The ``k`` best of every task for every item, ranked over all tasks."""
    shared = index.sparkSession.sparkContext.broadcast((ids, wanted, weights))
    key_type = index.schema["key"].dataType
    schema = T.StructType([field("q", "int"), T.StructField("item_id", id_type), T.StructField("doc_id", key_type), field("score", "long")])
    types = [pa_type(f.dataType) for f in schema.fields]

    def run(batches):
        names, queries, w = shared.value
        best = [[] for _ in names]  # per item: (-score, whether null, id), the best first

        def search(parts):
            keys = pa.concat_arrays([p[0] for p in parts])
            order = pc.sort_indices(keys, null_placement="at_end").to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            block = Block(rank, *(np.concatenate([p[i] for p in parts]) for i in range(1, 5)), n_docs, n_terms)
            for q, terms in enumerate(queries):
                lists = block.lists(terms, w[terms])
                if not lists:
                    continue
                docs, scores, _ = best_positions(lists, k, -best[q][k - 1][0] if len(best[q]) == k else 0)
                rows = [(-s, keys[int(order[d])].as_py()) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)]
                best[q] = sorted([*best[q], *((s, x is None, x) for s, x in rows)], key=lambda r: r[:2] if r[1] else r)[:k]

        parts, entries, documents = [], 0, 0
        for b in batches:
            counts = pc.list_value_length(b.column("terms")).to_numpy()
            ends = np.cumsum(counts)
            i = 0
            while i < b.num_rows:  # as many rows as the block has room for, one at least
                j = max(i + 1, min(int(np.searchsorted(ends, (ends[i - 1] if i else 0) + POSTINGS - entries, "right")), i + DOCUMENTS - documents))
                s = b.slice(i, j - i)
                parts.append((s.column("key"), s.column("n").to_numpy(), counts[i:j], s.column("terms").flatten().to_numpy(), s.column("tfs").flatten().to_numpy()))
                entries += int(counts[i:j].sum())
                documents += j - i
                i = j
                if entries >= POSTINGS or documents >= DOCUMENTS or i < b.num_rows:
                    search(parts)
                    parts, entries, documents = [], 0, 0
        if parts:
            search(parts)
        rows = [(q, names[q], x, -s) for q, found in enumerate(best) for s, _, x in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=schema.names)

    found = index.filter(F.size("terms") > 0).select("key", "n", "terms", "tfs").mapInArrow(run, schema)
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*COLUMNS)


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", *,
           k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's ``k`` best documents with a score above 0.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))) over the N documents with a term; a document of n terms scores the
    sum of weight * ((10^9 tf) div (1000 tf + 8 m)) over an item's distinct terms, with m = 10 + (90 n N) div L and L terms
    in all.  Equal scores rank by ascending id, null ids last.

    Null texts have no terms; a document without terms counts nowhere.  Repeated rows, of documents or of items, are rows
    of their own; an item without terms or without matches has no result.  Whole texts are read, a piece at a time.
    Columns of other names aren't read, so clashing names do no harm.  Either table may be empty.  The driver and each
    worker hold the terms of ``item_bytes`` of item text; more items are searched in that many passes over the documents.
    """
    ship(docs.sparkSession)
    asked = items.select(col(item_id).alias("id"), col(item_text).cast("string").alias("t")).filter("t is not null")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / item_bytes))
    rows = docs.select(col(key).alias("key"), col(text).cast("string").alias("text"))
    results = []
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64(F.col("id").cast("string"), "t"), F.lit(blocks)) == b).collect()  # about item_bytes
        queries = [terms_of(r["t"]) for r in part]
        vocabulary = {w: i for i, w in enumerate(sorted(set().union(*queries)))}
        index = _index(rows, vocabulary)
        n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(vocabulary), np.int64)
        for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row a term of these items
            weights[r["term"]] = weight(n_docs, r["count"])
        wanted = [np.array(sorted(vocabulary[w] for w in q if weights[vocabulary[w]] > 0), np.int64) for q in queries]
        results.append(_ranked(index, [r["id"] for r in part], wanted, asked.schema["id"].dataType, k, n_docs, max(n_terms, 1), weights))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
