"""Ranked search against scoring every document, and the stop rule of the best positions."""

import math
import re

import numpy as np
import pytest

from strata.llm import queries, ranking

SCHEMA = "doc_id long, text string, item_id string, rank string, score string, n string, terms string, key string"


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) by scoring every pair."""
    all_terms = [(i, terms(t)) for i, t in docs]
    all_terms = [(i, w, {x: w.count(x) for x in set(w)}) for i, w in all_terms if w]
    n_docs, n_terms = len(all_terms), sum(len(w) for _, w, _ in all_terms)
    out = []
    for item, t in items:
        scores = []
        for i, w, tf in all_terms:
            m = 100 - 90 + 90 * len(w) * n_docs // n_terms
            s = 0
            for x in set(terms(t)) & tf.keys():
                df = sum(x in other for _, _, other in all_terms)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1000000000 * tf[x] // (1000 * tf[x] + 8 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ranking.COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus():
    vocabulary = [f"w{i}" for i in range(60)] + ["École", "naïve", "x1", "3d"]
    docs = []
    for i in range(240):
        n = 1 + (i * 37) % 50
        docs.append((1000 - i, " ,.".join(vocabulary[(i * j * j + j + i // 7) % len(vocabulary)] for j in range(n)).upper().replace("É", "é")))
    docs += [(2000, None), (2001, ""), (2002, "!?"), (None, "w1 w2 W3"), (None, None), (3, docs[5][1]), (2, docs[5][1]), (2, docs[5][1]), (4, "only here  zebra zebra")]
    items = [(0, "w1 w2 w3 w1 École"), (1, "zebra"), (2, None), (3, ""), (4, "unknown terms"), (5, "W5 w6-w7 3D x1 naïve"), (5, "w9"), (None, "w10"), (7, " ".join(vocabulary))]
    return docs, items


@pytest.mark.parametrize("postings, item_bytes, partitions", [(1 << 21, 1 << 20, 3), (40, 60, 1), (300, 1 << 20, 7)])
def test_search_equals_scoring_every_document(spark, monkeypatch, postings, item_bytes, partitions):
    docs, items = corpus()
    monkeypatch.setattr(ranking, "POSTINGS", postings)
    monkeypatch.setattr(ranking, "DOCUMENTS", 50)
    d = spark.createDataFrame([(i, t, *"abcdef") for i, t in docs], SCHEMA).repartition(partitions)
    q = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    assert found(ranking.search(d, q, item_bytes=item_bytes)) == brute(docs, items)
    assert found(ranking.search(d, q, k=3)) == brute(docs, items, 3)


def test_long_text_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_PIECE", 1000)
    long = " ".join(f"w{i % 5000}" for i in range(300_000)) + "\x00" + "q" * 100_000
    docs = [(1, long), (2, "w1 w2"), (3, "w4999 w17 w17")]
    items = [(1, "w17 w4999"), (2, "w1 " + "q" * 100_000)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(ranking.search(d, q)) == brute(docs, items)
    assert found(ranking.search(d.limit(0), q)) == []
    assert found(ranking.search(d, q.limit(0))) == []


def test_pieces_count_like_a_whole():
    text = ("Été x1, w2 w2 " * 500).encode()
    words = {w: i for i, w in enumerate([b"x1", b"w2", "Été".encode().lower(), "Été".encode().translate(ranking._AS_WORDS)])}
    whole = ranking.term_counts(text, words)
    try:
        ranking._PIECE, kept = 7, ranking._PIECE
        assert ranking.term_counts(text, words) == whole
    finally:
        ranking._PIECE = kept
    assert whole[0] == 2000


def impact_lists(matrix, weights):
    out = []
    for q, w in zip(matrix, weights, strict=True):
        docs = np.flatnonzero(q)
        order = np.lexsort((docs, -q[docs]))
        place = np.empty(len(docs), np.int64)
        place[order] = np.arange(len(docs))
        out.append((w, docs[order], q[docs][order], docs, place))
    return out


def test_best_positions_stop_early_and_strictly_below():
    rng = np.random.default_rng(5)
    matrix = rng.integers(0, 1000, (3, 5000))
    matrix[:, 7] = 5000  # the best everywhere
    docs, scores, scored = ranking.best_positions(impact_lists(matrix, [3, 2, 1]), 1, step=1)
    assert docs.tolist() == [7] and scores.tolist() == [30000] and scored < 100
    for k in (1, 5, 40):
        docs, scores, scored = ranking.best_positions(impact_lists(matrix, [3, 2, 1]), k, step=2)
        total = 3 * matrix[0] + 2 * matrix[1] + matrix[2]
        want = np.lexsort((np.arange(5000), -total))[:k]
        assert docs.tolist() == want.tolist() and scores.tolist() == total[want].tolist() and scored < 5000
    # ties: an equal score of a lesser document that no list shows early must still be found
    tied = np.full((2, 300), 10)
    docs, _, scored = ranking.best_positions(impact_lists(tied[:, ::-1], [1, 1]), 4, step=1)
    assert docs.tolist() == [0, 1, 2, 3] and scored == 300
    # a floor from elsewhere ends the search at once, unless it can be equalled
    assert ranking.best_positions(impact_lists(tied, [1, 1]), 4, floor=21)[2] == 0
    assert ranking.best_positions(impact_lists(tied, [1, 1]), 4, floor=20)[2] == 300


def test_query_equals_scoring_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").limit(5).collect()]
    got = [r for r in found(queries.op13_search(spark, sf)) if r[0] in {i for i, _ in items}]
    assert got == brute(docs, items)
