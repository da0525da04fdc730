"""Licenses whose templates share words, and a search without any index."""

from collections import Counter

import pytest

from fleetlens.llm import license_scan as ls
from fleetlens.llm.queries import op2_license_scan


@pytest.fixture(scope="module")
def index():
    return ls.LicenseIndex()


@pytest.mark.parametrize(
    "text, names",
    [
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0-notice"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0-notice"]),
        ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0-notice"]),
        ("Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.", ["Apache-2.0-notice", "CC-BY-NC-4.0-notice"]),
        ("Licensed under CC BY-NC 4.0. and Licensed under CC BY-SA 4.0.", ["CC-BY-NC-4.0-notice", "CC-BY-SA-4.0-notice"]),
        (ls.TEMPLATES["Apache-2.0"], ["Apache-2.0"]),
        (ls.TEMPLATES["GPL-2.0-or-later"], ["GPL-2.0-or-later"]),
        ("Licensed under CC BY-NC 4.0. " * 3, ["CC-BY-NC-4.0-notice"] * 3),
    ],
)
def test_one_row_for_each_notice(index, text, names):
    found = index.matches(text)
    assert [m[0] for m in found] == names
    assert all(m[4] == 1.0 for m in found)


def common(a, b):
    """Length of the longest common subsequence, by rows."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def windows(template, words):
    """Starts of windows of the template's length and BAND more that hold enough of its words in order."""
    n, need = len(template), ls.LEAST_COVERAGE * len(template)
    want, have, shared = Counter(template), Counter(), 0
    for end, w in enumerate(words):
        have[w] += 1
        shared += have[w] <= want[w]
        start = end - n - ls.BAND + 1
        if start > 0:
            gone = words[start - 1]
            shared -= have[gone] <= want[gone]
            have[gone] -= 1
        if shared >= need and common(template, words[max(start, 0) : end + 1]) >= need:
            yield max(start, 0), end


def test_search_without_index_finds_the_same(spark):
    """Every window that holds a template overlaps a row of it, or of one with as many matched words; every row holds."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = {}
    for r in op2_license_scan(spark, "/root/testdata/sf0.01").collect():
        rows.setdefault(r.doc_id, []).append(r)
    templates = {name: ls.split_words(t) for name, t in ls.TEMPLATES.items()}
    seen = 0
    for key, text in docs.items():
        words = ls.split_words(text)
        places = ls.word_places(text)
        for r in rows.get(key, []):
            inside = ls.split_words(text[r.start : r.end])
            assert len(inside) <= len(templates[r.license]) + ls.BAND and common(templates[r.license], inside) == r.matched
        for name, template in templates.items():
            if not set(template) & set(words):
                continue
            for a, b in windows(template, words):
                seen += 1
                near = [r for r in rows.get(key, []) if r.start < places[b][1] and r.end > places[a][0]]
                assert any(r.license == name or r.matched >= ls.LEAST_COVERAGE * len(template) for r in near), (key, name)
    found = Counter(r.license for part in rows.values() for r in part)
    assert seen and found["CC-BY-NC-4.0-notice"]
    assert all(r.coverage == 1.0 for part in rows.values() for r in part if r.license == "CC-BY-SA-4.0-notice")
