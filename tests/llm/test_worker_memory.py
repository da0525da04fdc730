"""A reused Python worker holds the tables of one operator at a time."""

import pandas as pd
from fleetlens.llm import bpe, near_dedup, quality_mil
from fleetlens.llm.common import serving
from pyspark.sql import functions as F


def _held(frames):
    """In one task: what is left of the codec and of the remembered hashes after each operator."""
    text = pd.Series(["some words of a text"])
    path = bpe.public_path()
    for _ in frames:
        serving("bpe", bpe.codec.cache_clear)
        bpe.codec(path).encode(text[0])
        same = bpe.codec.cache_info().currsize
        serving("bpe", bpe.codec.cache_clear)
        again = bpe.codec.cache_info().currsize
        serving("near duplicates", near_dedup._hashes.clear)
        other = bpe.codec.cache_info().currsize
        near_dedup.shingles(text[0], 5)
        words = len(near_dedup._hashes)
        serving("quality")
        yield pd.DataFrame({"same": [same], "again": [again], "other": [other], "words": [words], "left": [len(near_dedup._hashes)]})


def test_one_operator_at_a_time(spark):
    r = spark.range(1).coalesce(1).mapInPandas(_held, "same int, again int, other int, words int, left int").first()
    assert (r.same, r.again, r.other, r.left) == (1, 1, 0, 0) and r.words == 5


def test_stages_drop_the_codec(spark):
    """The encoder's tables are gone from the worker once it scores texts."""
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text")).coalesce(1)
    left = lambda frames: (pd.DataFrame({"n": [bpe.codec.cache_info().currsize + 0 * len(f)]}) for f in frames)
    model = quality_mil.train([quality_mil.features("a b"), quality_mil.features("#### ####")], pd.Series([1.0, 0.0]).to_numpy())
    bpe.round_trip_digest(docs).collect()
    docs.select(quality_mil.score_column(model, F.col("text"))).collect()
    held = docs.coalesce(1).mapInPandas(left, "n int").collect()
    assert {r.n for r in held} == {0}


def test_links_in_tiles_are_staged(spark):
    """A stage of near-duplicates runs one Python worker a task: no plan has two Python steps without an exchange."""
    alive = spark.createDataFrame([(1, 1, 3, 1, 1), (1, 2, 3, 2, 1)], "key long, id long, n long, label long, main long")
    sets = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2, 3])], "id long, members array<long>")
    links = near_dedup._links_in_tiles(alive, sets)
    assert "InPandas" not in links._jdf.queryExecution().executedPlan().toString()
    assert {(min(r), max(r)) for r in links.collect()} == {(1, 2)}
