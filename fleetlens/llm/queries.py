"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import bpe, decontaminate, divergence, fill_in_middle, html_extract, license_scan, line_dedup, near_dedup, packing, pii, quality_mil, quality_rules, sharding
from fleetlens.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_removed", "row.text")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", license_scan.match_column(F.col("text")).alias("m"))
    return found.select("doc_id", F.explode_outer("m").alias("m")).where("m is not null").select("doc_id", "m.*")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", (quality_mil.fold(F.col("doc_id")) == 0).alias("held_out"), quality_mil.score_column(model, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= quality_mil.PASS_AT).cast("int")
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", html_extract.extract(pages).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), [1.0] * 8).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_duplicate_groups(table(spark, sf_dir, "documents"), size=4)
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.judge(docs, quality_rules.bucket_ratios(docs, trusted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.concat(*map(pii.as_spans, pii.KINDS[:4]))
    every = F.concat(base, pii.as_spans("found"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts[:4], F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(every).alias("spans"), counts[4], F.size(every).cast("long").alias("n_spans")
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE, "op12_divergence": divergence.ORACLE, "op13_fill_in_middle": fill_in_middle.ORACLE}
