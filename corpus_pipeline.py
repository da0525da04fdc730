"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next stage's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import bpe, decontaminate, line_dedup, near_dedup, quality_mil
from fleetlens.llm.common import checkpointed, remove, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels"))
    row = F.struct(*[F.col(c) for c in docs.columns])
    scored = docs.select(row.alias("row"), quality_mil.score_column(model, F.col("text")).alias("score"))
    return scored.where(F.col("score") >= quality_mil.PASS_AT).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in their first document; emptied documents go."""
    cleaned = line_dedup.cleaned_documents(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, of the least key (five-word shingles, 0.8).

    The verdicts are narrow and decided for each key and text, so rows that share a
    key do not protect each other; only those that go are joined, as an anti-join.
    Of a kept key and text that stands in the table more than once, one row comes back.
    Rows without words are in no group and stay.
    """
    surplus = checkpointed(near_dedup.surplus_rows(docs, size=5).select(F.col("doc_id").alias("_key"), F.col("digest").alias("_digest"), "kept"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_key")) & (near_dedup.text_digest(F.col("row.text")) == F.col("_digest"))
    alone = rows.join(surplus.drop("kept"), same, "left_anti")
    repeated = surplus.where("kept").drop("kept")
    if repeated.isEmpty():
        return alone.select("row.*")
    once = rows.join(repeated, same).groupBy("_key", "_digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return alone.union(once.select("row")).select("row.*")


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with the digests of both ways."""
    return bpe.round_trip_digest(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near-duplicates", near_stage),
    ("benchmark decontamination", leak_stage),
    ("BPE encoding", encode_stage),
]

#: The classifier and the embeddings have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a written table in the shared folder between stages.

    A stage's table goes once the next one is written; the last one stays, since the
    result reads it.
    """
    docs = table(spark, sf_dir, "documents")
    last = None
    for _, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir))
        if last is not None:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
