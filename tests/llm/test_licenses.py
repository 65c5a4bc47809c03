"""License scans against brute-force containment at every place of edited notices; both ways."""

import random

import numpy as np

from strata.llm import licenses
from strata.llm import words as W
from test_llm import SCHEMA, edge_rows, prose, words


def grams(w):
    return {tuple(w[i:i + licenses.SHINGLE]) for i in range(len(w) - licenses.SHINGLE + 1)}


def brute(text, templates):
    """Ids of the templates of which some place holds 0.8 of the shingles."""
    w, found = words(text), set()
    have = grams(w)
    for name, t, g in templates:
        if len(g & have) >= 0.8 * len(g):
            slack = max(1, int(len(t) * 0.2))
            if any(len(g & grams(w[max(0, a - slack):a + len(t) + slack])) >= 0.8 * len(g) for a in range(-slack, len(w))):
                found.add(name)
    return found


def test_edited_notices_are_found_where_brute_force_finds_them(spark):
    rng = random.Random(4)
    templates = [(n, words(t), grams(words(t))) for n, t in licenses.TEMPLATES]
    rows = []
    for _, t, _ in templates:
        for edits in (0, 1, 2, 3, len(t) // 8):
            w = list(t)
            for _ in range(edits):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([["changed"], [], ["put", w[at]]])
            rows.append(f"{prose(rng.randrange(30), edits + 2)} {' '.join(w)} {prose(rng.randrange(20), 7)}")
    got = licenses.scan_licenses(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    hits = 0
    for r in got:
        want, ids = brute(rows[r["doc_id"]], templates), set(filter(None, r["licenses"].split(",")))
        assert ids <= want and bool(ids) == bool(want), (rows[r["doc_id"]], ids, want)
        hits += bool(want)
    assert len(templates) < hits < len(rows) - 20  # both answers occur


def test_opening_lines_and_tags(spark):
    texts = {"GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone": "GPL-3.0",
             "Apache License\n Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION": "Apache-2.0",
             "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
             "and/or other materials provided with the distribution.": "BSD",
             "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "# SPDX-License-Identifier: MIT": "MIT", "SPDX-License-Identifier: Other": "", "license": ""}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(df).collect()} == dict(enumerate(texts.values()))


def test_windows_collide_as_often_as_stated():
    rng = np.random.default_rng(1)
    n, size = 4000, licenses.LONG - 1
    equal = rng.integers(0, 1 << 62, (n, size)).astype(np.uint64)
    for changed, least in ((0, 1.0), (1, 0.85)):  # of 7 pairs 1 replaced: similarity 6 / 8
        other = equal.copy()
        other[:, :changed] = rng.integers(0, 1 << 62, (n, changed)).astype(np.uint64)
        at = np.arange(n) * size
        hit = (licenses._band_keys(equal.ravel(), at, size) == licenses._band_keys(other.ravel(), at, size)).any(1).mean()
        assert hit >= least


def test_edges_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame(edge_rows(), SCHEMA).withColumnRenamed("score", "licenses").withColumnRenamed("kept", "n_matches")
    out = licenses.scan_licenses(df)
    assert out.count() == len(edge_rows()) and out.columns.count("licenses") == 1
    assert licenses.scan_licenses(df.limit(0)).collect() == []
    long = prose(60_000, 3) + " " + licenses.TEMPLATES[3][1] + " " + prose(20_000, 5)
    got = licenses.scan_licenses(spark.createDataFrame([(1, long)] * 2, "doc_id long, text string")).collect()
    assert [r["match_starts"] for r in got] == [[len(words(prose(60_000, 3)))]] * 2
    assert W.CHUNK_BYTES  # whole texts, a chunk each
