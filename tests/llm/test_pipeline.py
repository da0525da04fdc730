"""Every stage of the corpus pipeline on its own input, against plain Python."""

import hashlib

import corpus_pipeline
from fleetlens.llm import bpe, decontaminate, line_dedup, quality_mil
from pyspark.sql import functions as F
from tests.llm.test_lines_and_leaks import plain_dedup
from tests.llm.test_near_dedup import plain_groups

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, inputs = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        inputs[name] = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    inputs["out"] = docs.collect()
    quality, lines, near, leaks, encoded, out = inputs.values()

    model = quality_mil.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in quality if model is None or model.score([quality_mil.features(r.text)])[0] >= quality_mil.PASS_AT}
    assert {r.doc_id for r in lines} == kept and len(kept) < len(quality)

    want = {i: t for i, t, n in plain_dedup([(r.doc_id, r.text, r.source) for r in lines], line_dedup.MIN_SITES) if n == 0 or t.strip()}
    assert {r.doc_id: r.text for r in near} == want and all(r.n_chars == len(r.text) for r in near)

    want = {i for i, _, c in plain_groups([(r.doc_id, r.text) for r in near], 5) if i == c}
    assert {r.doc_id for r in leaks} == want

    norm = lambda s: b" %s " % b" ".join(decontaminate.split_words(s))
    items = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in leaks} - {r.doc_id for r in encoded}
    assert {r.doc_id for r in leaks if any(x in norm(r.text) for x in items)} <= gone

    codec = bpe.codec(bpe.public_path())
    assert len(out) == len(encoded)
    text = {r.doc_id: r.text for r in encoded}
    for r in out:
        ids = codec.encode(text[r.doc_id])
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()

    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, out))


def test_odd_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20).withColumn("row", F.lit(1)).withColumn("_gone", F.lit("x"))
    none = docs.withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for part in (docs.limit(0), none, docs.unionByName(docs)):
            out = stage(spark, part, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= 40
    assert corpus_pipeline.encode_stage(spark, none, SF).count() == 20
