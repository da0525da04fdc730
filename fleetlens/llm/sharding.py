"""Rendezvous (highest random weight) sharding, DataFrame functions only.

Every (record key, shard) pair gets a hash; the shard with the best weighted
score wins (Thaler and Ravishankar 1998; logarithmic weights after Schindelhauer
and Schomaker 2005). A record moves only if a new shard beats its winner, so one
more shard takes rows only into itself.

Defined results: rows with a NULL key share one key and so one shard; a NULL text
has size 1 and the checksum of the empty text; repeated rows each get a slot of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import key_text

#: Bits of the hash that make the uniform draw; a double holds them exactly.
DRAW_BITS = 53


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Index of the shard that wins ``key``; equal scores go to the lower index."""
    scale = float(1 << DRAW_BITS)
    scored = []
    for shard, weight in enumerate(weights):
        if weight <= 0:
            raise ValueError("shard weights must be positive")
        bits = F.xxhash64(F.concat(key_text(key), F.lit(f":{shard}"))).bitwiseAND(F.lit((1 << DRAW_BITS) - 1))
        draw = (bits.cast("double") + F.lit(0.5)) / F.lit(scale)
        scored.append(F.struct((F.lit(-float(weight)) / F.log(draw)).alias("score"), F.lit(-shard).alias("back")))
    return -F.array_max(F.array(*scored))["back"]


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    slot_buckets: int = 4096,
) -> DataFrame:
    """Shard, gapless slot and size of every row.

    Slots are numbered in two levels: rows within a (shard, bucket) group, groups
    by a running sum of their counts. No task holds a whole shard, and the offset
    table has at most ``len(weights) * slot_buckets`` rows, which bounds its
    broadcast. Text never leaves the scan: only the key and three numbers shuffle.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = (
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
        )
        .withColumn("shard", rendezvous(F.col("doc_id"), weights))
        .withColumn("grown_shard", rendezvous(F.col("doc_id"), [*weights, float(sum(weights)) / len(weights)]))
        .withColumn("bucket", F.pmod(F.xxhash64(key_text(F.col("doc_id")), "size", "text_crc32"), F.lit(slot_buckets)).cast("int"))
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    )
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("first_slot") + F.col("place")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
