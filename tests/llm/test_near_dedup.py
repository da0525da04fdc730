"""SuperMinHash, grouping and near-duplicate detection against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import near_dedup
from fleetlens.llm.queries import op8_near_duplicates

SF = "/root/testdata/sf0.01"


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_groups(docs, size):
    """Component of every row by comparing all pairs of different sets."""
    sets = {}
    for i, t in docs:
        sets.setdefault(shingle_set(t, size), []).append(i)
    uniq = [s for s in sets if s]
    parent = list(range(len(uniq)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for n, s in enumerate(uniq):
        for x in s:
            by.setdefault(x, []).append(n)
    for a, b in {p for v in by.values() if len(v) > 1 for p in combinations(v, 2)}:
        i = len(uniq[a] & uniq[b])
        if 100 * i >= 80 * (len(uniq[a]) + len(uniq[b]) - i):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    name = {}
    for n, s in enumerate(uniq):
        ids = [i for i in sets[s] if i is not None]
        if ids:
            name[root(n)] = min([*ids, *([name[root(n)]] if root(n) in name else [])])
    where = {s: name.get(root(n)) for n, s in enumerate(uniq)}
    return [(i, len(s), where[s] if s else i) for i, t in docs for s in [shingle_set(t, size)]]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for share in (0.2, 0.5, 0.8):
        for n in (40, 300, 3000):
            pool = rng.integers(0, 1 << 63, size=2 * n, dtype=np.int64).astype(np.uint64)
            k = int(2 * n * share / (1 + share))
            a, b = pool[:n], np.concatenate([pool[:k], pool[n : 2 * n - k]])
            got = np.mean(near_dedup.signature(a) == near_dedup.signature(b))
            errors.append(abs(got - k / (2 * n - k)))
    assert max(errors) < 0.16 and np.mean(errors) < 0.06
    assert (near_dedup.signature(pool) == near_dedup.signature(pool[::-1])).all()


def test_signature_gives_every_element_a_permutation():
    for seed in range(20):
        sig = near_dedup.signature(np.array([seed * 7919 + 1], dtype=np.uint64), 16)
        assert sorted((sig >> 32).tolist()) == list(range(16))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(150)]
    parent = {}
    for a, b in edges:
        x, y = a, b
        while parent.setdefault(x, x) != x:
            x = parent[x]
        while parent.setdefault(y, y) != y:
            y = parent[y]
        parent[max(x, y)] = min(x, y)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    got = {r.id: r.label for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    loops = {a for a, b in edges if a == b}
    assert set(got) >= {x for e in edges for x in e} - loops
    for a, b in combinations(sorted(got), 2):
        assert (got[a] == got[b]) == (root(a) == root(b))
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_an_ordered_chain(spark, monkeypatch):
    turns = []
    monkeypatch.setattr(near_dedup, "checkpointed", lambda df, f=near_dedup.checkpointed: turns.append(1) or f(df))
    n = 5000
    chain = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(200, F.xxhash64("a"))
    got = near_dedup.components(chain, few=0)
    assert got.count() == n and got.select("label").distinct().count() == 1
    assert len(turns) <= 14  # about log2 of the length
    assert near_dedup.components(chain).select("label").distinct().count() == 1


def test_candidate_links_are_no_more_than_members(spark, monkeypatch):
    """Links offered for a hot group grow with its members, not with its pairs."""
    seen = []
    monkeypatch.setattr(near_dedup, "_confirm", lambda pairs, *a, f=near_dedup._confirm: seen.append(pairs.count()) or f(pairs, *a))
    rng = random.Random(3)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    docs = [(i, " ".join([*base[: i % 140], f"z{i}", *base[i % 140 :]])) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = near_dedup.near_duplicate_groups(frame, size=4).select("component_id").distinct().collect()
    assert [r.component_id for r in got] == [0] and sum(seen) <= 2 * len(docs)


def test_common_shingles_alone_make_no_rows_of_pairs(spark, monkeypatch):
    """Sets of the same common shingles, near the threshold: pairs stay inside tasks, over many tiles."""
    seen = []
    monkeypatch.setattr(near_dedup, "TILE_SHINGLES", 4000, raising=False)
    monkeypatch.setattr(near_dedup, "_confirm", lambda pairs, *a, f=near_dedup._confirm: seen.append(pairs.count()) or f(pairs, *a))
    rng = random.Random(5)
    docs = [(i, " ".join(f"{'ab'[rng.randrange(2)]}{slot} " + " ".join(f"w{slot}_{k}" for k in range(7)) for slot in range(20))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = {i: c for i, _, c in plain_groups(docs, 4)}
    assert 20 < len(set(want.values())) < 190
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicate_groups(frame, size=4).collect()} == want
    assert max(seen) <= len(docs)


def test_query_equals_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: (n, c) for i, n, c in plain_groups(docs, 4)}
    rows = op8_near_duplicates(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all((r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id) for r in rows)
    assert sum(not r.kept for r in rows) > 30


def test_hot_group_keeps_every_link(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    docs = []
    for i in range(260):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        if i % 17 == 0 and docs:
            words = docs[rng.randrange(len(docs))][1].split()
            words[rng.randrange(len(words))] = f"y{i}"
        docs.append((1000 - i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicate_groups(frame, size=4).collect()}
    assert got == {i: c for i, _, c in plain_groups(docs, 4)} and len(set(got.values())) > 3


def test_odd_rows(spark):
    docs = [(5, None), (6, ""), (7, " \n"), (1, "A b"), (2, "a B"), (3, "a b c"), (None, "a b c"), (None, "x y z w"), (8, "p q r s t u"), (8, "p q r s t u"), (8, "other text here at all"), (9, "w " * 60000)]
    frame = spark.createDataFrame([(i, t, b"n", 1) for i, t in docs], "doc_id long, text string, node binary, n int")
    got = near_dedup.near_duplicate_groups(frame, size=4).collect()
    key = lambda rows: sorted(map(str, rows))
    assert key([tuple(r) for r in got]) == key(plain_groups(docs, 4))
    assert near_dedup.near_duplicate_groups(frame.limit(0)).collect() == []
    assert near_dedup.near_duplicate_groups(frame.where("doc_id = 5").select("doc_id", F.col("text"))).collect()[0].component_id == 5
