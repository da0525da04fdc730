"""License scan against whole alignments, and planted texts."""

import random

from fleetlens.llm import license_scan as L
from fleetlens.llm.queries import op2_license_scan

SF = "/root/testdata/sf0.01"


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_notices_of_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op2_license_scan(spark, SF).collect()
    notices = [n for n in L.TEMPLATES if n.endswith("notice") or n == "All-rights-reserved"]
    for name in notices:
        words = b" %s " % b" ".join(L.split_words(L.TEMPLATES[name]))
        want = {i for i, t in texts.items() if words in b" %s " % b" ".join(L.split_words(t))}
        got = {r.doc_id for r in rows if r.license == name and r.coverage == 1.0}
        assert got == want
    for r in rows:
        span = L.split_words(texts[r.doc_id][r.start : r.end])
        assert longest_common(L.split_words(L.TEMPLATES[r.license]), span) == r.matched
        assert r.coverage >= L.LEAST_COVERAGE


def test_planted_texts_with_edits():
    rng, index = random.Random(1), L.LicenseIndex()
    for name, text in L.TEMPLATES.items():
        words = text.split()
        if len(words) < 20:
            continue
        for _ in range(5):
            v = list(words)
            for _ in range(len(v) // 12):
                p = rng.randrange(len(v))
                v[p : p + rng.randrange(2)] = ["zzz"] * rng.randrange(2)
            doc = "intro words here " * 20 + " ".join(v) + " tail words" * 20
            best = [m for m in index.matches(doc) if m[0] == name]
            assert best, name
            whole = longest_common(L.split_words(text), L.split_words(doc))
            assert whole - 1 <= best[0][3] <= whole
            assert L.split_words(doc[best[0][1] : best[0][2]])[-1] in L.split_words(" ".join(v))


def test_banded_equals_full_alignment_in_the_band():
    rng = random.Random(2)
    for _ in range(200):
        t = [rng.randrange(6) for _ in range(rng.randrange(1, 15))]
        d = [rng.randrange(6) for _ in range(rng.randrange(1, 20))]
        assert L.align(t, d, 0, -len(t), len(d))[0] == longest_common(t, d)


def test_odd_rows(spark):
    assert [L.LicenseIndex().matches(x) for x in (None, "", "é ß", "word " * 50000)] == [[], [], [], []]
    twice = L.LicenseIndex().matches("All rights reserved." + " filler" * 50 + " ALL RIGHTS\nRESERVED")
    assert [m[0] for m in twice] == ["All-rights-reserved"] * 2 and twice[1][2] == len("All rights reserved." + " filler" * 50 + " ALL RIGHTS\nRESERVED")
    assert L.LicenseIndex({"x": "", "y": "one"}).matches("two one two")[0][:3] == ("y", 4, 7)
    docs = spark.createDataFrame([(1, None), (None, "All rights reserved"), (None, "All rights reserved")], "doc_id long, text string")
    assert [len(r[0]) for r in docs.select(L.match_column(docs.text)).collect()] == [0, 1, 1]
    assert docs.limit(0).select(L.match_column(docs.text)).collect() == []
