"""Sharding, quality rules and personal data against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import pii, quality_rules, sharding
from fleetlens.llm.queries import op5_sharding, op9_quality_rules, op10_pii

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def odd_docs(spark):
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, "  \n\t ", "x"),
        (4, "one\ntwo\none\n \none", None),
        (4, "one\ntwo\none\n \none", None),
        (None, "a b c a b c a b c", "y"),
        (None, "1 2 " * 30000, "y"),
        (7, "a" * 100000 + " mail me@x.org.uk, 10.0.0.1 +1 (017) 555-7713", "y"),
        (8, "4111 1111 1111 1111 and 256.1.1.1 and 1.2.3.4.5 a@b.c_d@e.f", "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket string")


def test_shards(spark, texts):
    rows = op5_sharding(spark, SF).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_follow_key_and_weight(spark):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = Counter(r.shard for r in sharding.assign_shards(ids, [1.0, 3.0]).select("shard").collect())
    assert abs(got[1] / got[0] - 3) < 0.25
    a = {r.doc_id: r.shard for r in sharding.assign_shards(ids, [1.0] * 4).collect()}
    b = {r.doc_id: r.shard for r in sharding.assign_shards(ids, [1.0] * 5).collect()}
    assert all(b[k] in (a[k], 4) for k in a) and sum(a[k] != b[k] for k in a) < 5000


def test_shards_odd(spark):
    rows = sharding.assign_shards(odd_docs(spark), [1.0, 1.0]).collect()
    assert len(rows) == 9 and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert sharding.assign_shards(odd_docs(spark).limit(0), [1.0]).collect() == []


def plain_rules(text):
    w = WORD.findall(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_rules(spark, texts):
    for r in op9_quality_rules(spark, SF).collect():
        want = plain_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and r.kept == (not failed and r.llr >= quality_rules.THRESHOLD)


def test_ratio_is_the_multinomial_one(spark):
    import math

    docs = spark.createDataFrame([(1, "a b a"), (2, "c *** c"), (3, None)], "doc_id long, text string")
    good = spark.createDataFrame([(1,), (None,)], "doc_id long")
    n = 1000
    got = {r.bucket: r.llr for r in quality_rules.bucket_ratios(docs, good, buckets=n).collect()}
    grams = {r.doc_id: r._grams for r in quality_rules.ngram_buckets(docs, "text", n).collect()}
    raw, target = Counter(g for x in grams.values() for g in x), Counter(grams[1])
    for b in range(n):
        want = math.log((target[b] + 1) / (sum(target.values()) + n)) - math.log((raw[b] + 1) / (sum(raw.values()) + n))
        assert abs(got[b] - want) < 1e-12
    out = {r.doc_id: r.llr for r in quality_rules.judge(docs, quality_rules.bucket_ratios(docs, good, buckets=n), buckets=n).collect()}
    assert out[1] > 0 > out[2] and out[3] == 0


def test_rules_odd(spark):
    docs = odd_docs(spark)
    ratios = quality_rules.bucket_ratios(docs, docs.limit(0).select("doc_id"))
    rows = quality_rules.judge(docs, ratios).collect()
    assert len(rows) == 9 and all(r.llr == 0 for r in rows)
    assert [r.n_dup_lines for r in rows if r.doc_id == 4] == [2, 2]
    assert quality_rules.judge(docs.limit(0), ratios).collect() == []


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_base(text):
    out = {k: [] for k in pii.KINDS[:4]}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text) if "@" in text else ():
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out["phone"].append(m.span())
    return out


def digest(spans):
    flat = sorted((a, i, b) for i, k in enumerate(pii.KINDS[:4]) for a, b in spans[k])
    return hashlib.sha256(",".join(f"{pii.KINDS[i]}:{a}:{b}" for a, i, b in flat).encode()).hexdigest()


def test_personal_data(spark, texts):
    rows = op10_pii(spark, "/root/testdata/sf0.01").collect()
    full = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = 0
    for r in rows:
        want = plain_base(full[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in pii.KINDS[:4]]
        assert r.base_sha256 == digest(want)
        for kind, a, b in (x.split(":") for x in r.spans.split(",") if x):
            if kind == "found":
                found += 1
                assert re.fullmatch(r"[0-9A-Fa-f]{40}", full[r.doc_id][int(a) : int(b)])
    assert len(rows) == 1000
    assert found == sum(len(re.findall(r'(?i)token = "[0-9a-f]{40}"', t)) for t in full.values())


def test_personal_data_odd(spark):
    rows = pii.find_personal_data(odd_docs(spark)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 9
    text = {r.doc_id: r.text or "" for r in odd_docs(spark).collect()}
    for k in (1, 2, 3, 7, 8):
        want = plain_base(text[k][-60:] if k == 7 else text[k])
        shift = len(text[k]) - 60 if k == 7 else 0
        if k == 7:
            want["email"] = [(100001 + 5, 100001 + 5 + len("me@x.org.uk"))]
        for kind in pii.KINDS[:4]:
            got = [(s.start, s.end) for s in by[k][kind]]
            assert got == [(a + (shift if kind != "email" else 0), b + (shift if kind != "email" else 0)) for a, b in want[kind]]
    assert pii.find_personal_data(odd_docs(spark).limit(0)).collect() == []


def test_context_discovers_unseen(spark):
    import random

    rng = random.Random(3)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'word pass = "{key()}" tail') for i in range(20)]
    rows += [(100 + i, f'more pass = "Zq{i}-unseen99" tail') for i in range(3)] + [(200 + i, f"room number {i}1234567 is free") for i in range(9)]
    got = {r.doc_id: r.found for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(got[100 + i]) == 1 for i in range(3)) and not any(got[200 + i] for i in range(9))


def test_patterns_discover_keys_that_are_no_seeds(spark):
    """With half of the key forms as seeds, the patterns find the rest, and passwords that no form knows."""
    import random

    rng = random.Random(11)
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    upper = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16))
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(6))
    rows, want = [], set()
    for i in range(240):
        value = [hexed(40), upper(), hexed(17) + "a"][i % 3]
        text = word() + [' token = "%s" ', " %s ", " password=%s "][i % 3] % value + word()
        want.add((i, text.index(value), text.index(value) + len(value)))
        rows.append((i, text))
    rows += [(1000 + i, f"{word()} in the year {1000 + i}/17 and release-{i}.2.17 of {word()}") for i in range(200)]
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), seed_share=0.5).collect()
    found = {(r.doc_id, s.start, s.end) for r in got for s in r.found}
    based = {r.doc_id for r in got if r.email or r.ip or r.card or r.phone}
    missed = {w for w in want - found if w[0] not in based}
    assert len(missed) <= 0.1 * len(want) and not found - want


def test_personal_data_of_a_long_text(spark):
    """Twice the identifiers cost about twice the time."""
    import time

    def seconds(n):
        frame = spark.createDataFrame([(1, " ".join(f"id{i}abc a{i}@b.org" for i in range(n)))], "doc_id long, text string")
        began = time.time()
        row = pii.find_personal_data(frame).selectExpr("size(email) as n", "email[0].start as a", f"email[{n - 1}].end as b", "size(found) as f").collect()[0]
        assert (row.n, row.a, row.b, row.f) == (n, 7, len(" ".join(f"id{i}abc a{i}@b.org" for i in range(n))), 0)
        return time.time() - began

    seconds(100)
    small = seconds(30_000)
    assert seconds(60_000) < 2.5 * small + 3


def test_rules_beside_columns_of_the_same_names(spark):
    rows = [(1, "one two three " * 40, "k", 5, "u"), (2, None, "k", 6, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int, _w string")
    ratios = quality_rules.bucket_ratios(docs, docs.select("doc_id").limit(1))
    got = quality_rules.judge(docs, ratios)
    plain = {r.doc_id: r for r in quality_rules.judge(docs.select("doc_id", "text"), ratios).collect()}
    assert got.columns == ["doc_id", "text", "_w", *quality_rules.RESULTS]
    for r in got.collect():
        assert r._w == {1: "u", 2: "v"}[r.doc_id] and all(r[c] == plain[r.doc_id][c] for c in quality_rules.RESULTS)
