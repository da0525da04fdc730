"""BPE against the tokenizers library, page extraction, and the quality model."""

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import bpe, html_extract, quality_mil
from fleetlens.llm.queries import op3_bpe, op4_quality, op7_html

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.public_path())


def test_bpe_equals_library(tok):
    c, rng = bpe.codec(bpe.public_path()), random.Random(5)
    samples = ["", " ", "a" * 30000, "ab" * 5000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "don't  I'll\t\n\n x", "日本語 😀😀 naïve"]
    for _ in range(3000):
        pool = rng.choice(["etaoinshr", "etaoinshr .,'\n", "".join(map(chr, range(32, 600))), "0123456789 ", "日本語テスト 😀é"])
        samples.append("".join(rng.choice(pool) for _ in range(rng.randrange(60))))
    for s in samples:
        want = tok.encode(s, add_special_tokens=False).ids
        assert c.encode(s) == want
        assert c.decode(want) == tok.decode(want, skip_special_tokens=False)


def test_decode_of_broken_sequences(tok):
    c, rng = bpe.codec(bpe.public_path()), random.Random(6)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(8))]
        assert c.decode(ids) == tok.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark, tok):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = op3_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(tok.decode(ids, skip_special_tokens=False))


def test_bpe_columns_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "x y"), (None, "x y")], "doc_id long, text string")
    rows = docs.withColumn("ids", bpe.encode_column("text")).withColumn("back", bpe.decode_column("ids")).collect()
    assert [r.back for r in rows] == ["", "", "x y", "x y"]
    assert bpe.round_trip_digest(docs.limit(0)).collect() == []


def plain_article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", "", inner)).split())


def test_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op7_html(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain_article(pages[r.page_id]) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("bare &amp; text", "bare & text"),
        ("<div>" * 20000 + "deep", "deep"),
        ("<p>a<b>b</b>c<br>d\n e<p>f", "abc d e f"),
        ("<body class='has-sidebar'><header>Site</header><div><p>One, two, three and more words.</p><p>Two</p></div><div class='comments'><p>x, y, z, a, b, c, d, e</p></div>", "One, two, three and more words. Two"),
        ("<nav><p>a, b, c</p></nav><main><p>Body, text.</p><form>f</form><aside>s</aside></main><footer>z</footer>", "Body, text."),
        ("<article><h1>T</h1><p>x</p><script>if (a < b) {}</script><style>p{}</style><!-- c --></article><div class=cookie-notice>n</div>", "T x"),
        ("<nav><a href=x>y</a></nav><script>1</script>", ""),
        ("<article><p>t</p><ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul></article>", "t"),
    ],
)
def test_page_shapes(page, want):
    assert html_extract.main_text(page) == want


def test_page_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", None), (2, None, "<p>x")], "page_id long, url string, html string")
    assert [r[0] for r in pages.select(html_extract.extract(pages)).collect()] == ["", "", "x"]
    assert pages.limit(0).select(html_extract.extract(pages)).collect() == []


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality_mil.FEATURES)) for n in (1, 3, 5)]
    y = np.array([1.0, 0.0, 1.0])
    model = quality_mil.GatedAttention(np.zeros(quality_mil.FEATURES), np.ones(quality_mil.FEATURES), rng)
    loss = lambda: -np.mean(np.log(np.where(y == 1, s := model.score(bags), 1 - s)))
    for name, grad in model.gradients(bags, y).items():
        at = tuple(rng.integers(0, n) for n in grad.shape)
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-5
        up = loss()
        model.p[name][at] = kept - 1e-5
        assert abs((up - loss()) / 2e-5 - grad[at]) < 1e-6
        model.p[name][at] = kept


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op4_quality(spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == 1000 and len(held) > 40
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    again = {r.doc_id: r.score for r in op4_quality(spark, sf).collect()}
    assert all(0 <= r.score <= 1 and abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "x" * 50000, 5), (3, "a b", 5)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    model = quality_mil.fit(docs, labels)
    assert model is None and [r[0] for r in docs.select(quality_mil.score_column(model, F.col("text"))).collect()] == [0.5] * 4
    two = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    more = spark.createDataFrame([(i, "THE!! $$$ ### " * 9 if i % 2 == 0 else "plain words here, as ever. ") for i in range(1, 40)], "doc_id long, text string")
    fitted = quality_mil.fit(more, two)
    scores = [r[0] for r in docs.select(quality_mil.score_column(fitted, F.col("text"))).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert docs.limit(0).select(quality_mil.score_column(fitted, F.col("text"))).collect() == []
