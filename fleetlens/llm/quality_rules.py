"""Importance-weight quality rules, DataFrame functions only.

Each text becomes hashed unigrams and bigrams of word and punctuation runs. Two
multinomials over the hash buckets are counted on whole tables: the raw corpus
and the trusted target (documents marked good). A document's verdict is the mean
log-likelihood ratio of its n-grams against a fixed threshold, so every document
is decided the same way each time (the resampling step of Xie et al. 2023, Data
Selection via Importance Resampling, is replaced by the threshold).

Defined results: a NULL text has no words; a text without n-grams scores 0; an
empty target or corpus gives ratio 0 everywhere; repeated rows are decided alike;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import words

#: Runs of letters, digits and underscores, or runs of anything else but white space.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
SYMBOLS = "[#*$%&|<>]"
GAPS = " \t\n\x0b\x0c\r"
BUCKETS = 10_000
#: Mean log-likelihood ratio from which a document is kept.
THRESHOLD = -0.25
SMOOTHING = 1.0
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept")
#: Repeated windows up to which each window is looked up among them.
FEW = 32
#: Trusted keys up to which they are broadcast; beyond it, both sides are shuffled.
BROADCAST_KEYS = 1_000_000


def _tail(name: str) -> str:
    return f"slice({name}, 2, greatest(size({name}) - 1, 0))"


def ngram_buckets(docs: DataFrame, text: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``_grams``: the bucket of each unigram, then of each bigram."""
    pairs = f"zip_with(slice(_h, 1, greatest(size(_h) - 1, 0)), {_tail('_h')}, (a, b) -> pmod(xxhash64(a, b), {buckets}))"
    return (
        docs.withColumn("_h", F.expr(f"transform(regexp_extract_all(coalesce({text}, ''), r'{TOKEN}', 0), x -> xxhash64(x))"))
        .withColumn("_grams", F.expr(f"concat(transform(_h, x -> pmod(x, {buckets})), {pairs})"))
        .drop("_h")
    )


def bucket_ratios(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """log p_target(bucket) / p_raw(bucket) for every bucket.

    ``trusted`` has the keys of the target documents. Both counts come from one
    pass over all documents; the partial aggregate leaves at most ``buckets`` rows
    a task to shuffle.
    """
    marked = trusted.select(F.col(key).alias("_key")).where("_key is not null").distinct().withColumn("_good", F.lit(1))
    marked = F.broadcast(marked) if marked.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else marked
    flagged = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(marked, "_key", "left")
    counted = (
        ngram_buckets(flagged, "_text", buckets)
        # The outer form: for the inner one Catalyst adds a filter that works out the array again.
        .select(F.explode_outer("_grams").alias("bucket"), F.coalesce("_good", F.lit(0)).alias("good"))
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    )
    every = (
        docs.sparkSession.range(buckets)
        .select(F.col("id").alias("bucket"))
        .join(counted, "bucket", "left")
        .select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    )
    total = every.agg(F.sum("raw").alias("raw_total"), F.sum("target").alias("target_total"))
    room = SMOOTHING * buckets
    ratio = F.log((F.col("target") + SMOOTHING) / (F.col("target_total") + room)) - F.log((F.col("raw") + SMOOTHING) / (F.col("raw_total") + room))
    known = (F.col("raw_total") > 0) & (F.col("target_total") > 0)
    return every.crossJoin(F.broadcast(total)).select("bucket", F.when(known, ratio).otherwise(F.lit(0.0)).alias("llr"))


def ratio_array(ratios: DataFrame) -> Column:
    """The ratios as a scalar subquery: one array of ``buckets`` doubles, by bucket."""
    return (
        ratios.agg(F.sort_array(F.collect_list(F.struct("bucket", "llr"))).alias("pairs"))
        .select(F.expr("transform(pairs, p -> p.llr)").alias("llr"))
        .scalar()
    )


def rule_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the five counts of the rule set; each is worked out inside the row."""
    body = F.coalesce(F.col(text), F.lit(""))
    windows = f"transform(slice(_h, 3, greatest(size(_h) - 2, 0)), (c, i) -> xxhash64(_h[i], _h[i + 1], c))"
    twice = "array_distinct(filter(_s, (x, i) -> i > 0 and x = _s[i - 1]))"
    # Starts of repeated windows: by lookup where few windows repeat, else from one sort of (window, start).
    look_up = "filter(sequence(0, size(_g) - 1), i -> array_contains(_d, _g[i]))"
    ordered = "sort_array(transform(_g, (h, i) -> struct(h as h, i as i)))"
    pair_hit = f"zip_with({ordered}, {_tail('__')}, (a, b) -> if(a.h = b.h, array(a.i, b.i), cast(array() as array<int>)))".replace("__", ordered)
    starts = f"case when size(_d) = 0 then cast(array() as array<int>) when size(_d) <= {FEW} then {look_up} else sort_array(array_distinct(flatten({pair_hit}))) end"
    covered = f"coalesce(aggregate(zip_with(_at, {_tail('_at')}, (a, b) -> least(3, b - a)), 0, (s, x) -> s + x), 0)"
    return (
        docs.withColumn("_w", words(body))
        .withColumn("_h", F.expr("transform(_w, x -> xxhash64(x))"))
        .withColumn("_g", F.expr(windows))
        .withColumn("_s", F.sort_array("_g"))
        .withColumn("_d", F.expr(twice))
        .withColumn("_at", F.expr(starts))
        .withColumn("_lines", F.expr(f"filter(split(coalesce({text}, ''), '\\n', -1), l -> length(translate(l, '{_sql(GAPS)}', '')) > 0)"))
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(body, F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.expr(covered).cast("long"))
        .drop("_w", "_h", "_g", "_s", "_d", "_at", "_lines")
    )


def _sql(chars: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in chars)


def judge(docs: DataFrame, ratios: DataFrame, text: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with rule counts, ``llr`` (mean over n-grams), ``base_failed`` and ``kept``.

    A column of ``docs`` with one of these names gives way to the result; all others stay.
    """
    if {c for c in docs.columns if c in RESULTS or c.startswith("_")}:
        held = F.struct(*[F.col(c) for c in docs.columns if c not in RESULTS]).alias("row")
        packed = docs.select(held, F.col(text).alias("text"))
        return judge(packed, ratios, "text", buckets, threshold).select("row.*", *RESULTS)
    scored = (
        ngram_buckets(rule_columns(docs, text), text, buckets)
        .withColumn("_ratio", ratio_array(ratios))
        .withColumn("llr", F.expr("aggregate(_grams, 0D, (s, g) -> s + _ratio[cast(g as int)])") / F.greatest(F.size("_grams"), F.lit(1)))
        .drop("_grams", "_ratio")
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
