"""One row of each near-duplicate group stays in the pipeline, whatever the keys."""

import corpus_pipeline


def test_rows_of_one_key_do_not_protect_each_other(spark):
    text = lambda s: " ".join(f"{s}{i}" for i in range(60))
    near = text("a").replace("a59", "z")
    rows = [(7, text("a"), 1), (7, text("a"), 1), (7, text("a"), 2), (7, text("b"), 1), (9, text("b"), 1), (9, near, 1)]
    rows += [(None, text("a"), 1), (None, text("c"), 1), (None, text("c"), 1), (None, near, 3), (8, text("d"), 1), (8, text("e"), 1), (8, None, 1), (8, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = sorted([(r.doc_id, r.text) for r in corpus_pipeline.near_stage(spark, docs, "").collect()], key=str)
    want = [(7, text("a")), (7, text("b")), (None, text("c")), (8, text("d")), (8, text("e")), (8, None), (8, "")]
    assert got == sorted(want, key=str)


def test_a_repeated_table_leaves_what_the_table_leaves(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    once = sorted(map(str, corpus_pipeline.near_stage(spark, docs, "").collect()))
    assert sorted(map(str, corpus_pipeline.near_stage(spark, docs.union(docs), "").collect())) == once
