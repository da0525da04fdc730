"""Sequence packing against the tokenizers library and plain bookkeeping."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlens.llm import packing
from fleetlens.llm.bpe import public_path

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_path(packing.TOKENIZER))


def check(rows, texts, tokenizer, limit):
    """Every id in one piece, sequences gapless and full but for powers of two."""
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for _, t in texts]
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_key[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sum(r.length for r in rows) == sum(map(len, want))
    for key, ids in zip([k for k, _ in texts], want):
        if [k for k, _ in texts].count(key) > 1:
            continue
        at = 0
        for r in sorted(by_key[key], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == limit or at & (at - 1) == 0 and at < limit


def test_table_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(packing.packed(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer, packing.LIMIT)


def test_odd_documents(spark, tokenizer):
    texts = [(1, None), (2, ""), (3, "  \n"), (4, "one two"), (4, "one two"), (4, "one two"), (None, "no key"), (None, None), (7, "word " * 9000), (8, "x" * 20000), (9, "<|endoftext|> İ ﬁ 𝒳 ́e é"), (2**60 + 1, "key")]
    df = spark.createDataFrame(texts, SCHEMA).withColumn("ids", F.lit("other")).withColumn("rest", F.lit(1)).withColumn("part", F.lit(2)).repartition(3)
    for limit in (4096, 16):
        check(packing.packed(df, limit=limit).collect(), texts, tokenizer, limit)
    assert packing.packed(df.limit(0)).collect() == []
    assert 2**60 + 1 in {r.doc_id for r in packing.packed(df).collect()}


def test_hot_length(spark, tokenizer):
    texts = [(i, "same length here") for i in range(400)] + [(1000 + i, "w " * i) for i in range(60)]
    check(packing.packed(spark.createDataFrame(texts, SCHEMA).repartition(5), limit=64).collect(), texts, tokenizer, 64)


def test_sequences_hold_the_ids(spark, tokenizer):
    texts = [(i, f"document {i} " + "and more " * (i % 9)) for i in range(50)]
    pieces = packing.packed(spark.createDataFrame(texts, SCHEMA), limit=32, with_ids=True)
    found = {r.sequence_id: r.ids for r in packing.sequences(pieces).collect()}
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for i, t in texts}
    for r in pieces.collect():
        assert r.ids == want[r.doc_id][r.start : r.start + r.length] == found[r.sequence_id][r.offset : r.offset + r.length]


def test_encoder_equals_library(tokenizer):
    rng = random.Random(5)
    encoder = packing.WordEncoder(public_path(packing.TOKENIZER))
    inside = [chr(c) for c in range(0x20, 0x180) if chr(c) != "İ"] + list("‐‘’“”…€‰⁞\t\n\r\x0b\x0c")
    beyond = inside + list("İΣς́가ﬁ𝒳​\x1c\x85 ²")
    for letters in (inside, beyond, list("ab'’stre1 !\n")):
        for _ in range(300):
            text = "".join(rng.choices(letters, k=rng.randrange(60)))
            assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    every = "".join(c for c in inside)
    assert encoder.encode(every).tolist() == tokenizer.encode(every, add_special_tokens=False).ids


def test_plan_fills_every_pack():
    rng = random.Random(3)
    for _ in range(60):
        limit = rng.choice((4, 16, 64, 100))
        histogram = {length: rng.randrange(1, 50) for length in rng.sample(range(1, limit), rng.randrange(1, limit - 1))}
        plan = packing.Plan(histogram, limit)
        length = np.repeat(list(histogram), list(histogram.values()))
        rank = np.concatenate([np.arange(n) for n in histogram.values()])
        fill, done = defaultdict(list), np.zeros(len(length), dtype=int)
        for row, start, taken, pack, offset in plan.pieces(length, rank):
            assert (start == done[row]).all()
            done[row] += taken
            for p, o, n in zip(pack.tolist(), offset.tolist(), taken.tolist()):
                fill[p].append((o, n))
        assert (done == length).all() and len(fill) == plan.packs
        for spans in fill.values():
            end = 0
            for o, n in sorted(spans):
                assert o == end
                end += n
            assert end == limit or end & (end - 1) == 0


def test_longest_first_into_the_emptiest():
    """Packs of 10: the 6s open packs, then the 4s and 3s go where most room is."""
    plan = packing.Plan({6: 2, 4: 1, 3: 1, 1: 1}, 10)
    length, rank = np.array([6, 6, 4, 3, 1]), np.array([0, 1, 0, 0, 0])
    (row, start, taken, pack, offset), *tails = plan.pieces(length, rank)
    assert not tails and pack.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 6, 9] and taken.tolist() == length.tolist() and row.tolist() == [0, 1, 2, 3, 4]


def test_lengths_beyond_the_limit_are_refused():
    with pytest.raises(ValueError):
        packing.Plan({5: 1}, 5)
