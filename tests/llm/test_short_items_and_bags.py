"""Benchmark items of a few words against plain search; the bound of the classifier's sample."""

import random

import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, quality_mil


def plain_search(item: list[str], words: list[str]) -> list[tuple[int, int]]:
    out, p = [], 0
    while p + len(item) <= len(words):
        if words[p : p + len(item)] == item:
            out.append((p, p + len(item)))
            p += len(item)
        else:
            p += 1
    return out


def test_short_items_equal_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        letters = "abc"[: rng.randint(1, 3)]
        items = [(i, [rng.choice(letters) for _ in range(rng.randint(1, 4))]) for i in range(6)]
        words = [rng.choice(letters + "d") for _ in range(rng.randint(0, 25))]
        got = decontaminate.ItemIndex([(i, " ".join(w)) for i, w in items]).matches(" ".join(words))
        assert got == sorted(((i, a, b, 0) for i, w in items for a, b in plain_search(w, words)), key=lambda m: (str(m[0]), m[1:]))


def test_short_items_beside_long_ones(spark):
    long = "one two three four five six seven"
    items = spark.createDataFrame([(1, long), (2, "Two, three"), (3, "seven"), (4, ""), (5, "..."), (None, "one")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {long} seven"), (2, "two three"), (3, "two x three"), (4, None), (5, "SEVEN")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start_word, r.end_word, r.distance) for r in decontaminate.leak_rows(docs, items).collect())
    assert got == [(1, 1, 1, 8, 0), (1, 2, 2, 4, 0), (1, 3, 7, 8, 0), (1, 3, 8, 9, 0), (2, 2, 0, 2, 0), (5, 3, 0, 1, 0)]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, items).collect()) == [2, 3, 4, 5]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, items, shortest=1).collect()) == [3, 4]


def test_passages_are_not_underestimated(spark):
    rng = random.Random(8)
    texts = [None, "", " ", "a" * 100_000, "b " * 6400] + ["".join(rng.choice("ab   ") * rng.choice([1, 1, 500]) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    for r in spark.createDataFrame([(t,) for t in texts], "text string").select("text", quality_mil.most_passages(F.col("text")).alias("most")).collect():
        held = len(list(quality_mil.passages(r.text)))
        assert held <= r.most <= 2 * held + 2


def test_long_bags_train_whole_within_the_bound(spark, monkeypatch):
    rows = [(i, ("good words here and there. " if i % 2 else "#$ %% && ") * (4000 if i < 4 else 20)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    seen = []
    train = quality_mil.train
    monkeypatch.setattr(quality_mil, "train", lambda bags, y: seen.append((bags, y)) or train(bags[:10], y[:10]))
    assert quality_mil.fit(docs, labels) is not None
    trained = [r.doc_id for r in labels.where(quality_mil.fold(F.col("doc_id")) != 0).orderBy("doc_id").collect()]
    texts = dict(rows)
    bags = seen[0][0]
    assert len(bags) == len(trained)
    for i, bag in zip(trained, bags):
        assert np.array_equal(bag, quality_mil.features(texts[i]).astype(np.float16).astype(np.float32))
    assert max(map(len, bags)) > 200
    quality_mil.fit(docs, labels, max_passages=100)
    fewer = seen[1][0]
    assert 0 < len(fewer) < len(bags) and sum(map(len, fewer)) <= 100
