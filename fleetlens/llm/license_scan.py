"""License scan: winnowed fingerprints, inverted index, banded alignment.

Template texts are cut to words; hashes of K-word runs are winnowed (Schleimer,
Wilkerson and Aiken 2003) and indexed. Every K-word run of a document is looked up,
so each indexed fingerprint that occurs is found. Hits on nearby diagonals make a
candidate, which a banded alignment scores: matched words in order within BAND of
the candidate's diagonals give coverage of the template and the matched span. Exact
copies are taken first; hits outside accepted spans are aligned again until none passes.
Templates share words, so spans of several can lie on one notice: of those that overlap,
the one with most matched words stays (then the best coverage, then the first name).

Defined results: a NULL or empty text has no matches; templates without words never
match; a template found twice gives two rows; no span is longer than its template by
over BAND words; repeated rows match alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

K, WINDOW = 3, 4
#: Words an alignment may drift from the diagonals of its hits.
BAND = 8
LEAST_COVERAGE = 0.75
MATCH = "array<struct<license:string,start:int,end:int,matched:int,coverage:double>>"
_BREAKS = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))

# Public license texts and notices.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-notice": "Released under the MIT License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "All-rights-reserved": "All rights reserved.",
}


def winnow(codes: list, window: int = WINDOW) -> set[int]:
    """Positions of the fingerprints: the least code of each window, rightmost on ties."""
    if len(codes) <= window:
        return {min(range(len(codes)), key=lambda i: (codes[i], -i))} if codes else set()
    return {min(range(i, i + window), key=lambda j: (codes[j], -j)) for i in range(len(codes) - window + 1)}


def align(template: list[int], words: list[int], first: int, low: int, high: int) -> tuple[int, int, int]:
    """Most template words in order within diagonals ``low``..``high``.

    Row i of the band holds document places i + low .. i + high. Returns matched
    words and the first and last matched document places (absolute); among equal
    counts the shortest span wins.
    """
    width = high - low + 1
    none = (0, 0, 0)
    row = [none] * (width + 2)  # cell d + 1: best up to document place i + low + d
    for i, t in enumerate(template):
        new = [none] * (width + 2)
        for d in range(width):
            place = i + low + d
            best = max(new[d], row[d + 2], key=lambda c: (c[0], c[1] - c[2]))
            if 0 <= place < len(words) and words[place] == t:
                count, start, _ = row[d + 1]
                hit = (count + 1, start if count else place, place)
                best = max(best, hit, key=lambda c: (c[0], c[1] - c[2]))
            new[d + 1] = best
        row = new
    best = max(row, key=lambda c: (c[0], c[1] - c[2]))
    return best[0], first + best[1], first + best[2]


def chained(hits: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Hits (diagonal, place) in chains whose diagonals have gaps of BAND at most."""
    group: list[tuple[int, int]] = []
    for h in sorted(hits):
        if group and h[0] > group[-1][0] + BAND:
            yield group
            group = []
        group.append(h)
    if group:
        yield group


def copies(template: list[int], ids: list[int], hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(first, last, matched) of all copies, which do not overlap."""
    n, out, work = len(template), [], []
    end = 0
    for d in sorted({d for d, _ in hits}):
        if d >= end and ids[d : d + n] == template:
            out.append((d, d + n - 1, n))
            end = d + n
    hits, at, low = sorted(hits, key=lambda h: h[1]), 0, 0
    for first, last in [*[x[:2] for x in out], (len(ids), len(ids))]:
        part = []
        while at < len(hits) and hits[at][1] < first:
            if hits[at][1] >= low:
                part.append(hits[at])
            at += 1
        work += [(chain, low, first, True) for chain in chained(part)]
        low = last + 1
    # A chain is aligned whole, then in parts of bounded width, so that long rows of copies cost little.
    width = 2 * n + 6 * BAND
    while work:
        chain, low, high, whole = work.pop()
        top = chain[-1][0] if whole else min(chain[-1][0], chain[0][0] + width)
        begin, end = max(low, chain[0][0] - BAND), min(high, top + BAND + n)
        if end - begin < LEAST_COVERAGE * n:
            matched = 0
        else:
            matched, a, b = align(template, ids[begin:end], begin, chain[0][0] - BAND - begin, top + BAND - begin)
        if matched >= LEAST_COVERAGE * n and b - a >= n + BAND:
            # Words of two places: look at each end alone, in a window that ends before the other.
            left, right = min(high, a + n + BAND), max(low, b - n - BAND + 1)
            work += [(c, low, left, False) for c in chained([h for h in chain if h[1] < left])]
            work += [(c, right, high, False) for c in chained([h for h in chain if h[1] >= right])]
        elif matched >= LEAST_COVERAGE * n:
            out.append((a, b, matched))
            work += [(c, low, a, False) for c in chained([h for h in chain if h[1] < a])]
            work += [(c, b + 1, high, False) for c in chained([h for h in chain if h[1] > b])]
        elif top < chain[-1][0]:
            work.append((chain[1:], low, high, False))
    return out


class LicenseIndex:
    """Inverted index of winnowed template fingerprints."""

    def __init__(self, templates: dict[str, str] | None = None):
        self.vocab: dict[bytes, int] = {}
        self.templates: dict[str, list[int]] = {}
        self.postings: dict[tuple[int, ...], list[tuple[str, int]]] = defaultdict(list)
        for name, text in (TEMPLATES if templates is None else templates).items():
            words = [self.vocab.setdefault(w, len(self.vocab)) for w in split_words(text)]
            if not words:
                continue
            self.templates[name] = words
            runs = [tuple(words[i : i + K]) for i in range(max(1, len(words) - K + 1))]
            for i in winnow([hash(r) for r in runs]) if len(words) > K + WINDOW else range(len(runs)):
                self.postings[runs[i]].append((name, i))
            if K < len(words) < 2 * K:  # one edited word may leave no K-word run
                for i in sorted({0, len(words) - K + 1}):
                    self.postings[tuple(words[i : i + K - 1])].append((name, i))
        self.starts = {run[0] for run in self.postings}
        self.short = sorted({len(run) for run in self.postings if len(run) < K})

    def matches(self, text: str | None) -> list[tuple[str, int, int, int, float]]:
        """(license, start, end, matched words, coverage) by start; places in code points."""
        if not text:
            return []
        get = self.vocab.get
        ids = [get(w, -1) for w in split_words(text)]
        starts, postings = self.starts, self.postings
        hits: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for p, w in enumerate(ids):
            if w in starts:
                for size in (*self.short, K):
                    for name, at in postings.get(tuple(ids[p : p + size]), ()):
                        hits[name].append((p - at, p))
        if not hits:
            return []
        spans = [(name, a, b, matched, matched / len(self.templates[name])) for name, found in hits.items() for a, b, matched in copies(self.templates[name], ids, found)]
        if not spans:
            return []
        places = word_places(text)
        return [(name, places[a][0], places[b][1], matched, coverage) for name, a, b, matched, coverage in without_overlaps(spans)]


def without_overlaps(spans: list[tuple[str, int, int, int, float]]) -> list[tuple[str, int, int, int, float]]:
    """Spans (license, first, last, matched, coverage) by place, the better one of each two that share a word."""
    kept: list[tuple[int, int]] = []  # (first, last) by place, disjoint
    out = []
    for span in sorted(spans, key=lambda s: (-s[3], -s[4], s[0], s[1])):
        first, last = span[1], span[2]
        i = bisect_left(kept, (first, first))
        if (i and kept[i - 1][1] >= first) or (i < len(kept) and kept[i][0] <= last):
            continue
        insort(kept, (first, last))
        out.append(span)
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def split_words(text: str) -> list[bytes]:
    return text.lower().encode().translate(_BREAKS).split()


def word_places(text: str) -> list[tuple[int, int]]:
    """Code point spans of the words that ``split_words`` gives."""
    out, start = [], -1
    for i, c in enumerate(text):
        if c.isascii() and not c.isalnum():
            if start >= 0:
                out.append((start, i))
                start = -1
        elif start < 0:
            start = i
    return [*out, (start, len(text))] if start >= 0 else out


def match_column(text: Column, templates: dict[str, str] | None = None) -> Column:
    """License matches of every text, as array<struct<license,start,end,matched,coverage>>."""

    @F.pandas_udf(MATCH)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = LicenseIndex(templates)
        names = ("license", "start", "end", "matched", "coverage")
        for part in parts:
            yield pd.Series([[dict(zip(names, m)) for m in index.matches(x)] for x in part], dtype=object)

    return run(text)
