"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

Templates and texts are cut into overlapping windows, one at every word: of ``LONG`` words for templates that have twice as many, of
``SHORT`` words for shorter notices.  A window is the set of its word pairs; ``BANDS`` bands of ``ROWS`` MinHash values are its keys.
Windows of Jaccard similarity s share a key with probability 1 - (1 - s^ROWS)^BANDS: 1 where they are equal, 0.90 at 0.66.
The place of the windows says where in the text the template would lie, and the exact share of its shingles that stand there decides.

A passage that holds 0.8 of a template's shingles misses at most a fifth of them, and every word that is replaced costs
up to three.  Whatever the template's length, some stretch of ``LONG`` words between two such words is left as it was in a template of ``2 * LONG``
words or more (the least is eight, of 17 with the middle one replaced); shorter notices go by ``SHORT`` words, a shingle.  So a match has at least one
window equal to the template's and is retrieved with certainty; similar windows retrieve it again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import field, map_text

LONG, SHORT, BANDS, ROWS, SHINGLE = 8, 3, 4, 2, 3
COLUMNS = ["licenses", "n_matches", "match_ids", "match_starts", "match_words", "match_shares"]

# Notices by which texts state their licenses, and passages with which license texts begin or that tell them; SHORT words or more each.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
             "published by the Free Software Foundation"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
            "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
            "and/or other materials provided with the distribution."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
            "without specific prior written permission."),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."),
] + [(x, f"SPDX-License-Identifier: {y}") for x, y in (
    ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"), ("GPL-3.0", "GPL-3.0-only"), ("GPL-3.0", "GPL-3.0-or-later"),
    ("LGPL-2.1", "LGPL-2.1-or-later"), ("LGPL-3.0", "LGPL-3.0-or-later"), ("AGPL-3.0", "AGPL-3.0-or-later"), ("BSD", "BSD-2-Clause"), ("BSD", "BSD-3-Clause"),
    ("MPL-2.0", "MPL-2.0"), ("ISC", "ISC"), ("Unlicense", "Unlicense"), ("CC0-1.0", "CC0-1.0"), ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("BSL-1.0", "BSL-1.0"))]


def _pairs(h: np.ndarray) -> np.ndarray:
    """A hash of each word with the next."""
    return W.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])


def _band_keys(pairs: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Band keys (windows by BANDS) of the windows of ``size`` word pairs that start at ``starts``."""
    keys = np.zeros((len(starts), BANDS), np.uint64)
    for n in range(BANDS * ROWS):
        v = pairs * (W.mix(np.uint64(n + 1)) | np.uint64(1))
        v ^= v >> np.uint64(32)
        least = v[starts]
        for k in range(1, size):
            least = np.minimum(least, v[starts + k])
        keys[:, n // ROWS] = W.mix(keys[:, n // ROWS] + least * np.uint64(2 * (n % ROWS) + 1))
    return keys


class Windows:
    """Band keys of all windows of ``window`` words of some templates, and where each window stands."""

    def __init__(self, window: int, templates: list[tuple[int, np.ndarray]]):
        """``templates``: number and word hashes of each."""
        self.window, size = window, window - 1
        pairs, template, place = [], [], []
        for n, h in templates:
            p = _pairs(h)
            for at in range(len(p) - size + 1):
                pairs.append(p[at:at + size])
                template.append(n)
                place.append(at)
        self.template, self.place = np.array(template, np.int64), np.array(place, np.int64)
        self.pairs = np.array(pairs, np.uint64).reshape(-1, size)
        keys = np.concatenate([_band_keys(p, np.zeros(1, np.int64), size) for p in self.pairs]) if pairs else np.zeros((0, BANDS), np.uint64)
        self.order = [np.argsort(keys[:, b], kind="stable") for b in range(BANDS)]
        self.keys = [keys[o, b] for b, o in enumerate(self.order)]  # sorted; a window each
        self.bits = np.zeros((BANDS, 1 << 16), bool)
        for b in range(BANDS):
            self.bits[b][(keys[:, b] >> np.uint64(48)).astype(np.int64)] = True

    def candidates(self, h: np.ndarray, p: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Rows (text, template, first word in the chunk): each way a window of the texts could lie in a template, by a shared key
        and, of long windows, half of the pairs or more."""
        per = np.maximum(np.diff(first) - self.window + 1, 0)
        if not per.sum() or not len(self.template):
            return []
        owner = np.repeat(np.arange(len(per)), per)
        starts = first[owner] + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        keys, found = _band_keys(p, starts, self.window - 1), []
        for b in range(BANDS):
            near = np.flatnonzero(self.bits[b][(keys[:, b] >> np.uint64(48)).astype(np.int64)])
            lo, hi = np.searchsorted(self.keys[b], keys[near, b], "left"), np.searchsorted(self.keys[b], keys[near, b], "right")
            w = np.repeat(near, hi - lo)
            mine = self.order[b][np.repeat(lo, hi - lo) + np.arange(len(w)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
            there = p[starts[w][:, None] + np.arange(self.window - 1)]
            shared = (self.pairs[mine][:, :, None] == there[:, None, :]).any(2).sum(1)
            ok = 2 * shared >= self.window - 1
            found.append(np.stack([owner[w[ok]], self.template[mine[ok]], starts[w[ok]] - self.place[mine[ok]]], 1))
        return found


class Index:
    """The windows of all templates, long and short, and the templates' shingles."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.ids, self.size, self.shingles = [], [], []
        sides: dict[int, list] = {LONG: [], SHORT: []}
        for n, (name, text) in enumerate(templates):
            raw = np.frombuffer(text.encode(), np.uint8)
            starts, ends, _ = W.spans(raw, np.array([0, len(raw)]))
            h = W.hashes(raw, starts, ends)
            if len(h) < SHORT:
                raise ValueError(f"a template needs {SHORT} words or more: {text!r}")
            self.ids.append(name)
            self.size.append(len(h))
            self.shingles.append(np.unique(W.shingles(h, np.array([0, len(h)]), SHINGLE)[0]))
            sides[LONG if len(h) >= 2 * LONG else SHORT].append((n, h))
        self.sides = [Windows(w, t) for w, t in sides.items()]

    def candidates(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, template, first word in the chunk, keys that say so) of each way a window of the texts could lie in a template."""
        if len(h) < SHORT:
            return []
        p = _pairs(h)
        found = [x for side in self.sides for x in side.candidates(h, p, first)]
        if not found:
            return []
        places, votes = np.unique(np.concatenate(found), axis=0, return_counts=True)
        return [(*x, v) for x, v in zip(places.tolist(), votes.tolist(), strict=True)]


def scan_licenses(docs: DataFrame, text: str = "text", *, templates: list[tuple[str, str]] | None = None, containment: float = 0.8,
                  carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the matches of ``templates`` in each whole text: ``match_ids`` with ``match_starts`` (word numbers),
    ``match_words`` (length of the template) and ``match_shares`` (of its shingles found there), their number ``n_matches``, and ``licenses``, the distinct
    ids, sorted and comma-joined.  Such columns in ``docs`` are replaced.

    Of matches that overlap, that of the most template words found stays (then the greater share, the place that most windows tell, the earlier one, the earlier template).  Null and empty texts have none.
    Repeated rows get equal results; an empty table gives an empty result.
    """
    index = docs.sparkSession.sparkContext.broadcast(Index(TEMPLATES if templates is None else templates))

    def make():
        ix = index.value

        def run(texts):
            out = []
            for i, j, data, off in W.chunks(texts):
                starts, ends, first = W.spans(data, off)
                h = W.hashes(data, starts, ends)
                found: dict[int, list] = {}
                for t, n, a, votes in ix.candidates(h, first):
                    size = ix.size[n]
                    slack = max(1, int(size * (1 - containment)))
                    lo, hi = max(int(first[t]), a - slack), min(int(first[t + 1]), a + size + slack)
                    if hi - lo >= SHINGLE:
                        there = np.unique(W.shingles(h[lo:hi], np.array([0, hi - lo]), SHINGLE)[0])
                        share = float(np.isin(ix.shingles[n], there, assume_unique=True).mean())
                        if share >= containment:
                            found.setdefault(t, []).append((-share * size, -share, -votes, max(a, int(first[t])) - int(first[t]), n))
                for t in range(j - i):
                    taken: list[tuple] = []
                    for _, share, _, a, n in sorted(found.get(t, ())):
                        if all(a + ix.size[n] <= b or b + ix.size[m] <= a for b, m, _ in taken):
                            taken.append((a, n, -share))
                    taken.sort()
                    out.append((",".join(sorted({ix.ids[n] for _, n, _ in taken})), len(taken), [ix.ids[n] for _, n, _ in taken],
                                [a for a, _, _ in taken], [ix.size[n] for _, n, _ in taken], [s for _, _, s in taken]))
            return [list(c) for c in zip(*out, strict=True)]
        return run

    kinds = ["string", "long", "array<string>", "array<long>", "array<long>", "array<double>"]
    return map_text(docs, text, [field(c, k) for c, k in zip(COLUMNS, kinds, strict=True)], make, carry)
