"""License scans.

Fingerprints of the templates (winnowed k-grams of words) stand in an inverted
index.  A document's fingerprints that are found there, grouped by template and
diagonal, pick candidate places; a banded alignment of the template with the words
there gives the matched coverage and span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.text import grams, slices, winnow, words

K = 3
WINDOW = 3
COVERAGE = 0.8

#: Short notices, and the fixed parts of common texts.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}


def align(t: np.ndarray, d: np.ndarray, offset: int, lo: int, hi: int) -> tuple[int, int, int]:
    """Longest common subsequence of words t and d within a band, where position in d + offset - position in t is lo to hi.

    Returns (matched words, first and one past the last matched position of d).
    """
    n, width = len(t), hi - lo + 1
    score = np.zeros((n + 1, width + 1), dtype=np.int32)  # column c of row i: position lo + i + c - offset in d, one before it was used
    for i in range(n):
        at = lo + i - offset + np.arange(width)
        ok = (at >= 0) & (at < len(d))
        equal = np.zeros(width, dtype=np.int32)
        equal[ok] = d[at[ok]] == t[i]
        row = score[i, :width] + equal
        row = np.maximum(row, score[i, 1:])
        score[i + 1, :width] = np.maximum.accumulate(row)
        score[i + 1, width] = score[i + 1, width - 1]
    i, c = n, width - 1
    first, last, total = -1, -1, int(score[n, width - 1])
    while i > 0 and score[i, c] > 0:
        at = lo + i - 1 + c - offset
        if c > 0 and score[i, c - 1] == score[i, c]:
            c -= 1
        elif score[i - 1, c + 1] == score[i, c]:
            i, c = i - 1, c + 1
        else:
            first, last = at, last if last >= 0 else at
            i -= 1
    return total, first, last + 1


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: dict[str, str], k: int, window: int):
        self.names, self.k, self.window = list(templates), k, window
        w = words(pa.array(list(templates.values()), pa.string()))
        self.words = [w.hash[w.first[i] : w.first[i + 1]] for i in range(w.rows)]
        g, firsts = grams(w, k, short=False)
        at = winnow(g, firsts, window)
        row = np.searchsorted(firsts, at, side="right") - 1
        order = np.argsort(g[at], kind="stable")
        self.fp, self.row, self.pos = g[at][order], row[order], (at - firsts[row])[order]

    def scan(self, w, least: float) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(row, template, coverage, first and end word, matched words)."""
        g, firsts = grams(w, self.k, short=False)
        at = winnow(g, firsts, self.window)
        if not len(at) or not len(self.fp):
            return
        lo = np.searchsorted(self.fp, g[at], side="left")
        hit = np.flatnonzero(self.fp[np.minimum(lo, len(self.fp) - 1)] == g[at])
        row = np.searchsorted(firsts, at[hit], side="right") - 1
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for h, r in zip(hit.tolist(), row.tolist()):
            p = int(at[h] - firsts[r])
            for j in range(int(lo[h]), int(np.searchsorted(self.fp, g[at[h]], side="right"))):
                found.setdefault((r, int(self.row[j])), []).append((p - int(self.pos[j]), p))
        for (r, t), hits in found.items():
            doc, template = w.hash[w.first[r] : w.first[r + 1]], self.words[t]
            slack = max(2, len(template) // 8)
            hits.sort()
            groups, last = [], None
            for diagonal, p in hits:
                if last is None or diagonal - last > slack:
                    groups.append([diagonal, diagonal])
                groups[-1][1] = last = diagonal
            got = []
            for a, b in groups:
                low, high = a - slack, b + slack
                begin, end = max(0, low), min(len(doc), high + len(template))
                n, first, stop = align(template, doc[begin:end], begin, low, high)
                if n >= least * len(template):
                    got.append((n, begin + first, begin + stop))
            taken: list[tuple[int, int]] = []
            for n, first, stop in sorted(got, key=lambda x: (-x[0], x[1])):
                if all(stop <= x or first >= y for x, y in taken):
                    taken.append((first, stop))
                    yield r, t, n / len(template), first, stop, n


def scan(docs: DataFrame, templates: dict[str, str] | None = None, k: int = K, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, matched_words, start_word, end_word) for each template found in a text.

    coverage is the share of the template's words that align, at least `coverage`;
    words count from 0 and end_word is one past the last.  A template has a row for
    each place in the text; places that overlap a better one of the same template
    don't.  Templates of fewer than k words are never found; null and empty texts
    have no rows; repeated rows are scanned each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Index(TEMPLATES if templates is None else templates, k, window))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part, w in slices(batch):
                out = list(index.scan(w, coverage))
                r, t, c, a, b, n = zip(*out) if out else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(r, pa.int64())), pa.array([index.names[i] for i in t], pa.string()), pa.array(c, pa.float64()), pa.array(n, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                    names=["doc_id", "license", "coverage", "matched_words", "start_word", "end_word"],
                )

    return rows.mapInArrow(each, "doc_id long, license string, coverage double, matched_words int, start_word int, end_word int")
