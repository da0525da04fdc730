"""Source divergence against plain Python."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least=10, most=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(la or "", so or "", [t.translate(lower) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", tx or "")]) for _, tx, la, so in rows]
    out = []
    for lang in {la for la, _, _ in found}:
        df = Counter(t for la, _, ts in found if la == lang for t in set(ts))
        kept = {t for t, n in df.items() if n >= least}
        counts = defaultdict(Counter)
        for la, so, ts in found:
            if la == lang:
                counts[so].update(t for t in ts if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))  # noqa: B023, E731
        far = lambda p, q: (p - q) ** 2 // (p + q)
        for so, c in counts.items():
            pairs = [(sum(far(share(c, t), share(d, t)) for t in kept), other) for other, d in counts.items() if other != so]
            terms = [(far(share(c, t), share(whole, t)), t) for t in kept if c[t] > 0 and share(c, t) > share(whole, t)]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, so, part, item, v, k + 1) for k, (v, item) in enumerate(items) if part == "pair" or k < most]
    return sorted(out)


def documents(seed, n=160):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "Éa", "é", "éa", "ÀB", "zz", "one-two", "x1y", "日本", "q", "__", "42"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(25))), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "c", "ß", None])) for i in range(n)]
    return rows + [(n, None, "fr", "only"), (n + 1, "rare", "it", "x"), (n + 2, "42", "it", "y"), (n + 3, "", None, None)] + [rows[0]] * 3


def test_equals_plain_python(spark):
    for seed in range(2):
        rows = documents(seed)
        df = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("total", F.lit(2)).repartition(3)
        assert sorted(map(tuple, dv.audit(df).select("lang", "source", "part", "item", "value", "rank").collect())) == brute(rows)
    assert dv.audit(df.limit(0)).collect() == []


def test_sql_equals_plain_python():
    rows = documents(7)
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    assert sorted(con.execute(dv.ORACLE).fetchall()) == brute(rows)


def test_tiles_and_deals(spark, monkeypatch):
    """Many tiles of few sources and many deals of few columns give the same."""
    monkeypatch.setattr(dv, "SOURCES_AT_ONCE", 2)
    monkeypatch.setattr(dv, "COLUMNS_AT_ONCE", 3)
    monkeypatch.setattr(dv, "HELD_TERMS", 5)
    rows = documents(3)
    assert sorted(map(tuple, dv.audit(spark.createDataFrame(rows, SCHEMA)).select("lang", "source", "part", "item", "value", "rank").collect())) == brute(rows)


def test_equal_columns_are_evaluated_once(spark):
    rows = [(i, "aa bb cc dd ee", "en", "s" if i % 2 else "t") for i in range(20)]
    columns = dv.term_columns(dv.counted_terms(spark.createDataFrame(rows, SCHEMA)))
    assert columns.count() == 5 and columns.select("lang", "counts").distinct().count() == 1


def test_counts_beyond_64_bits(spark):
    n, whole, kept = 10**14, 3 * 10**14, 5
    want = 1 + 10**9 * (n + 2) // (whole + 2 * kept)
    assert dv._shares(np.array([n, 0]), whole, kept).tolist() == [want, 1 + 10**9 * 2 // (whole + 2 * kept)]
    row = spark.range(1).select(dv.share(F.lit(n), F.lit(whole), F.lit(kept)).alias("p")).first()
    assert row.p == want


def test_long_text(spark):
    rows = [(i, "lang " * 50_000 if i == 0 else "lang word", "en", f"s{i % 2}") for i in range(12)]
    assert sorted(map(tuple, dv.audit(spark.createDataFrame(rows, SCHEMA)).select("lang", "source", "part", "item", "value", "rank").collect())) == brute(rows)


def test_terms_are_shuffled_once(spark):
    df = spark.createDataFrame(documents(3), SCHEMA).repartition(3)
    plan = dv.term_columns(dv.counted_terms(df), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_counts_of_a_worker_that_passes_terms_on(spark, monkeypatch):
    monkeypatch.setattr(dv, "HELD_TERMS", 2)
    rows = documents(4)
    found = dv.audit(spark.createDataFrame(rows, SCHEMA).repartition(2)).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, found.collect())) == brute(rows)
