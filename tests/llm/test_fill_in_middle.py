"""Fill-in-middle against plain slicing."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import fill_in_middle as fim

SCHEMA = "doc_id long, text string"
#: Units by regular expression, to compare the event tables with.
PATTERNS = {"code_point": r"(?s).", "word": r"[\t-\r ]|[^\t-\r ]+", "line": r"\n|[^\n]+"}


@pytest.mark.parametrize("unit", PATTERNS)
def test_units_and_places(unit):
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices("ab é𝒳 \n\t<P>", k=rng.randrange(40)))
        events = fim.Events(text, fim.scanner(unit, fim.SENTINELS))
        starts = [m.start() for m in re.finditer(PATTERNS[unit], text)]
        assert events.units == len(starts) and events.sentinel == any(s in text for s in fim.SENTINELS)
        assert [events.place(r) for r in range(events.units + 1)] == [*starts, len(text)]


def plain(key, text):
    text = text or ""
    h = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, "<S>" + s + "<P>" + p + "<M>" + m) if h4 % 100 < 20 else (n, "psm", a, b - a, "<P>" + p + "<S>" + s + "<M>" + m)


def test_rows(spark):
    texts = [(i, f"text {i} é𝒳\n" * (i % 7)) for i in range(200)] + [(300, None), (301, "a<P>b"), (302, "a <S"), (302, "a <S"), (303, "<M>"), (304, "P> <S"), (2**60 + 1, "long"), (-5, "x" * 100_000)]
    df = spark.createDataFrame(texts, SCHEMA).withColumn("n", F.lit("clash")).withColumn("form", F.lit(1)).withColumn("output", F.lit(1))
    cut = fim.fill_in_middle(df)
    rows = cut.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in rows if r.form != "plain")
    want = sorted((k, *plain(k, t), t) for k, t in texts if plain(k, t)[1] != "plain")
    assert got == want
    assert sorted((r.doc_id, r.output, r.back) for r in rows if r.form == "plain") == sorted((k, t or "", t or "") for k, t in texts if plain(k, t)[1] == "plain")
    assert fim.fill_in_middle(df.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None, "no key at all"), (None, "no key at all")], SCHEMA)
    assert len({(r.form, r.output) for r in fim.fill_in_middle(nulls).collect()}) == 1


def test_other_units_come_back(spark):
    texts = [(i, "one two\n three  four\n" * (i % 4)) for i in range(60)]
    for unit in ("word", "line"):
        cut = fim.fill_in_middle(spark.createDataFrame(texts, SCHEMA), unit=unit, seed=9)
        rows = cut.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
        assert {(r.doc_id, r.back) for r in rows} == set(texts)
        assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_sql_on_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "a<S>"), (4, "é𝒳 ñ"), (5, "x\ny")]
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", texts)
    want = sorted(con.execute(fim.ORACLE).fetchall(), key=str)
    cut = fim.fill_in_middle(spark.createDataFrame(texts, SCHEMA))
    rows = cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256), F.sha2(fim.restored(F.col("output"), F.col("form")), 256)).collect()
    assert sorted(map(tuple, rows), key=str) == want


def test_short_sentinels_are_refused():
    with pytest.raises(ValueError):
        fim.Scanner("word", ("<",))
