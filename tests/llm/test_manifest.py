"""The Merkle manifest against a plain one: small chunks, so that butterfly rounds, ragged last subtrees and many parts occur."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos string, part string, root string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes, fanout):
    """All levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        top = levels[-1]
        levels.append([h(*top[i:i + fanout]) for i in range(0, len(top), fanout)])
    return levels


def path_of(levels, i, fanout):
    """(siblings before, siblings after) at each level."""
    out = []
    for nodes in levels[:-1]:
        first = i // fanout * fanout
        out.append((nodes[first:i], nodes[i + 1:first + fanout]))
        i //= fanout
    return out


def lower(t):
    return t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows, fanout=8):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    parts = defaultdict(list)
    for r in rows:
        parts[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: levels_of([x[2] for x in sorted(parts[p], key=lambda x: x[:3])], fanout) for p in order}
    over = levels_of([trees[p][-1][0] for p in order], fanout)
    out = []
    for k, p in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(parts[p], key=lambda x: x[:3])):
            path = path_of(trees[p], i, fanout) + path_of(over, k, fanout)
            bad = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0
            node = leaf((*r[:4], lower(r[4]))) if bad else own
            for before, after in path:
                node = h(*before, node, *after)
            out.append((r[0], own, trees[p][-1][0], over[-1][0], h(*(x for b, a in path for x in b + a)), node, node == over[-1][0]))
    return sorted(out, key=str)


def built(df, **kw):
    leaves, parts = manifest.merkle_manifest(df, COLUMNS, tampered={"text": manifest.lowered(F.col("text"))},
                                             where=manifest.chosen(F.col("doc_id")), **kw)
    got = leaves.select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted((tuple(r) for r in got), key=str), parts


def rows_of(n, langs):
    return [(i * 7 % n, f"s{i % 5}", langs[i * i % len(langs)], i, f"Text {i} É ß" if i % 4 else f"plain {i}") for i in range(n)]


@pytest.mark.parametrize("n, langs, fanout, chunk_levels", [
    (1, ["en"], 8, 3), (9, ["en"], 8, 1), (150, ["en", "fr", None, "de", "en", "en"], 2, 1), (333, ["en", "x", "x", "é", "", None], 3, 2),
    (150, [f"l{i}" for i in range(40)] + [None, "", "ä"], 3, 1), (131, ["en"], 8, 1)])
def test_manifest_equals_a_plain_one(spark, n, langs, fanout, chunk_levels):
    rows = rows_of(n, langs)
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "a", "b", "c", "d") for r in rows], SCHEMA).repartition(3)
    got, parts = built(df, fanout=fanout, chunk_levels=chunk_levels)
    want = brute(rows, fanout)
    assert got == want
    assert {r["subroot"] for r in parts.collect()} == {x[2] for x in want}
    assert sum(r["n"] for r in parts.collect()) == n
    assert [x[6] for x in got].count(False) == sum(zlib.crc32(str(r[0]).encode()) % 3 == 0 and lower(r[4]) != r[4] for r in rows)


def test_nulls_repeats_long_texts_and_ties(spark):
    long = "Aa bBé " * 200_000
    rows = [(None, None, None, None, None)] * 3 + [(5, "s", "en", 1, "Same")] * 70 + [(5, "s", "en", 1, "Other"), (6, "s", "en", 1, ""), (7, "s", "en", 1, None),
            (8, "s", "en", 9, long), (None, "s", "en", 1, "No id")]
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "a", "b", "c", "d") for r in rows], SCHEMA)
    got, _ = built(df, fanout=2, chunk_levels=2)
    # rows that are equal in all columns have one leaf, but a place and a proof each
    assert got == brute(rows, 2)
    leaves, _ = manifest.merkle_manifest(df, COLUMNS, fanout=2, chunk_levels=2)
    assert leaves.filter("not verified").count() == 0


def test_empty_table(spark):
    got, parts = built(spark.createDataFrame([], SCHEMA))
    assert got == [] and parts.count() == 0


def test_query_equals_a_plain_one(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS).collect()]
    assert sorted((tuple(r) for r in queries.op12_merkle(spark, sf).collect()), key=str) == brute(rows)
