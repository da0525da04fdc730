"""Line dedup and benchmark decontamination against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, line_dedup
from fleetlens.llm.queries import op1_line_dedup, op6_decontamination

SF = "/root/testdata/sf0.01"


def plain_dedup(docs, min_sites):
    sites, first = defaultdict(set), {}
    for i, text, site in docs:
        for x in (text or "").split("\n"):
            if x := x.strip(" \t\r"):
                sites[x].add(site)
                if i is not None:
                    first[x] = min(first.get(x, i), i)
    out = []
    for i, text, _ in docs:
        if text is None:
            out.append((i, None, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if len(sites.get(k := x.strip(" \t\r"), ())) < min_sites or first.get(k) == i]
        out.append((i, "\n".join(kept), len(lines) - len(kept)))
    return out


def test_line_dedup_query(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: (t, n) for i, t, n in plain_dedup(docs, line_dedup.MIN_SITES)}
    rows = op1_line_dedup(spark, SF).collect()
    assert len(rows) == len(docs) and sum(r.n_removed for r in rows) > 100
    assert all((r.text, r.n_removed) == want[r.doc_id] for r in rows)


def test_near_threshold_lines_are_counted(spark):
    docs = [(i, f"line {n}\nown {i}-{n}", f"site {s}") for n in range(30, 50) for s in range(n) for i in [n * 100 + s]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = line_dedup.remove_boilerplate(frame, min_sites=40).select("row.*", "n_removed").collect()
    want = {i: (t, n) for i, t, n in plain_dedup(docs, 40)}
    assert all((r.text, r.n_removed) == want[r.doc_id] for r in rows) and len(rows) == len(docs)


def test_sketch_errors_on_both_sides_are_counted(spark):
    """Coarse sketches put lines of too few sites above the threshold and lines of enough below it."""
    docs = [(n * 10_000 + r * 100 + s, f"line {n} {r}", f"site {r} {s}") for n in (38, 39, 40, 41) for r in range(30) for s in range(n) for _ in range(2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    true = {r._line: r.n for r in line_dedup._occurrences(frame, "doc_id", "source", "text").groupBy("_line").agg(F.count_distinct("_site").alias("n")).collect()}
    guess = {r._line: r.sites for r in line_dedup.estimated_sites(frame, 40, log_registers=6).collect()}
    assert any(guess[x] >= 40 > n for x, n in true.items()) and any(guess[x] < 40 <= n for x, n in true.items())
    found = {r._line: r.sites for r in line_dedup.boilerplate(frame, 40, log_registers=6).collect()}
    assert found == {x: n for x, n in true.items() if n >= 40} and len(found) == 60


def test_sites_are_counted_for_near_lines_alone(spark):
    """The pass over all lines shuffles by line; sites are shuffled only behind the semi-join."""
    docs = [(i, f"everywhere\nfew {i % 3}", f"site {i % 30}") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    near = line_dedup.estimated_sites(frame, 10).collect()
    assert [(round(r.sites), r.near) for r in near if r.sites > 15] == [(30, False)] and len(near) == 4
    assert sorted(round(r.sites) for r in line_dedup.boilerplate(frame, 10).collect()) == [10, 10, 10, 30]


def test_line_dedup_odd_rows(spark):
    docs = [(1, None, "a"), (1, "x\n\nx\n ", "a"), (2, "x", None), (2, "x", None), (None, "x\ny", "c"), (3, "\t", "d"), (4, "x\r", "e")]
    frame = spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, text string, source string, _bad int")
    rows = line_dedup.remove_boilerplate(frame, min_sites=3).select("row.*", "n_removed").collect()
    assert sorted(map(str, [(r.doc_id, r.text, r.n_removed) for r in rows])) == sorted(map(str, plain_dedup(docs, 3)))
    assert all(r._bad == 9 for r in rows)
    kept = line_dedup.cleaned_documents(frame, min_sites=3)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {1, None, 3}
    assert line_dedup.cleaned_documents(frame.limit(0)).collect() == []


def test_text_of_many_lines(spark):
    """Twice the lines cost about twice the time: no array is searched for each line."""
    import time

    def seconds(n):
        rows = [(0, f"{'s' * 200}", "z")] + [(i, "\n".join(f"line {j}" for j in range(n)), f"site {i}") for i in range(1, 3)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
        frame.count()
        began = time.time()
        got = line_dedup.remove_boilerplate(frame, min_sites=2).select("row.doc_id", "n_removed", "row.text").collect()
        assert {(r.doc_id, r.n_removed, len(r.text) > 0) for r in got} == {(0, 0, True), (1, 0, True), (2, n, False)}
        return time.time() - began

    seconds(1000)
    small = seconds(200_000)
    assert seconds(400_000) < 2.5 * small + 3


def test_null_texts_are_rows(spark, tmp_path):
    import duckdb

    rows = [(i, None if i % 4 == 0 else f"Same line\nown {i}\n", f"s{i % 6}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op1_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_removed", "text").collect()))
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(db.execute(f"select doc_id, n_lines, n_removed, text from ({line_dedup.ORACLE})").fetchall())
    assert got == want and len(got) == 40 and sum(r[2] for r in got) == 29


def plain_distance(item, words):
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, w in enumerate(words, 1):
            last, row[j] = row[j], min(last + (x != w), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_leaks_equal_all_alignments(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    docs = [(i, t) for i, t in docs if len(t) < 4000]
    rng, split = random.Random(4), decontaminate.split_words
    for n, (_, text) in enumerate(items):
        words = [w.decode() for w in split(text)]
        for edits in {0, decontaminate.edits_allowed(len(words)) // 2, decontaminate.edits_allowed(len(words)), decontaminate.edits_allowed(len(words)) + 2}:
            v = list(words)
            for _ in range(edits):
                p = rng.randrange(len(v))
                v[p : p + rng.randrange(2)] = [f"z{rng.randrange(99)}"] * rng.randrange(2)
            docs.append((10_000 + 10 * n + edits, " ".join([*docs[n % 60][1].split()[:30], *v, *docs[n % 50][1].split()[:30]])))
    index = decontaminate.ItemIndex(items)
    missed = extra = total = 0
    for _, text in docs:
        got = {m[0]: m[3] for m in index.matches(text)}
        words = split(text)
        for item_id, t in items:
            item = split(t)
            best = plain_distance(item, words)
            true = best <= decontaminate.edits_allowed(len(item))
            total += true
            missed += true and item_id not in got
            extra += item_id in got and got[item_id] != best
    assert total > 100 and extra == 0 and missed <= 0.01 * total


def test_leak_query(spark):
    norm = lambda s: b" ".join(decontaminate.split_words(s))
    items = [(r.item_id, b" %s " % norm(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for i, x in items if x in b" %s " % norm(r.text)}
    got = {(r.doc_id, r.item_id) for r in op6_decontamination(spark, SF).collect()}
    assert want and want <= got


def test_leaks_odd_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, None, 2), (1, "", 2), (None, "one two three four five six", 2), (3, "ONE, two... three\nfour five six!", 2)], "doc_id long, text string, m int")
    items = spark.createDataFrame([(1, "One two three four five six"), (2, "one two three four five six"), (3, None), (4, "the"), (None, "one two three four five six")], "item_id long, text string")
    got = docs.select("doc_id", decontaminate.find_leaks(docs, items).alias("x")).collect()
    assert [[m.item_id for m in r.x] for r in got] == [[], [], [1, 2], [1, 2]]
    monkeypatch.setattr(decontaminate, "ITEMS_A_PASS", 2)
    again = docs.select("doc_id", decontaminate.find_leaks(docs, items).alias("x")).collect()
    assert [sorted(m.item_id for m in r.x) for r in again] == [[], [], [1, 2], [1, 2]]
    assert [r.x for r in docs.select(decontaminate.find_leaks(docs, items.limit(0)).alias("x")).collect()] == [[]] * 4
    assert docs.limit(0).select(decontaminate.find_leaks(docs, items)).collect() == []


def test_every_occurrence_is_a_match():
    rng = random.Random(6)
    item = [f"w{rng.randrange(500)}" for _ in range(30)]
    edited = [*item[:10], "zz", *item[11:25], *item[26:]]
    index = decontaminate.ItemIndex([("a", " ".join(item)), ("b", " ".join(item))])
    words = [*item, *item, *edited, "x", "y", "z", *item, *edited]
    found = index.matches(" ".join(words))
    assert [m[1:] for m in found if m[0] == "a"] == [m[1:] for m in found if m[0] == "b"] == [(0, 30, 0), (30, 60, 0), (60, 89, 2), (92, 122, 0), (122, 151, 2)]
    assert len(index.matches(" ".join(item * 500))) == 1000


def test_ids_of_any_type_and_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x one two three four five six y", 0), (2, None, 0), (3, "none of it here at all", 0)], "doc_id long, text string, leaks int")
    items = spark.createDataFrame([("q-1", "One two three four five six"), ("q-2", "two three four five six y"), ("q-3", "other words stand here and there")], "item_id string, text string")
    rows = decontaminate.leak_rows(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in rows) == [(1, "q-1", 0), (1, "q-2", 0)]
    monkeypatch.setattr(decontaminate, "ITEMS_A_PASS", 1)
    assert sorted(map(str, decontaminate.leak_rows(docs, items).collect())) == sorted(map(str, rows))
    left = decontaminate.without_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
    assert decontaminate.leak_rows(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("n", [15, 37, 59])
def test_embedding_recall_at_threshold(n):
    rng = random.Random(n)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(n))) for i in range(60)]
    index, hit = decontaminate.ItemIndex(items), 0
    for i, text in items:
        v = text.split()
        for p in rng.sample(range(n), decontaminate.edits_allowed(n)):
            v[p] = "other"
        hit += i in {m[0] for m in index.matches(" ".join(["a b c", *v, "d e f"]))}
    assert hit >= 59
