"""Sequence packing: shortest pack first over the histogram of lengths.

Whole sequences of long documents are cut off first; what is left of every document
enters a histogram of at most ``limit - 1`` lengths, which is all the driver sees
(public description: Krell and others 2021, "Efficient sequence packing without
cross-contamination"). Lengths are placed longest first, each into the packs with the
most room, by groups of packs that share a packing pattern and a count; a new pack is
opened only where no open one has room. The number of packs is set by the tokens: as
many of ``limit`` as they fill, and one of each power of two in the remainder, so no
token of padding is needed. Where every pack is open and none has room, the length is
cut: its head fills the packs with the most room, its tail returns to the histogram.
The patterns are joined back to documents by the rank of a document among those of its
length.

Defined results: a NULL or empty text is the end token alone; repeated rows and NULL
keys are documents of their own; a text of any length is cut as often as needed; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.bpe import byte_letters, public_path
from fleetlens.llm.common import written

LIMIT, END_ID, TOKENIZER = 4096, 2, "word_bpe_49k.json"
#: Documents a worker tokenises before it passes them on.
ROWS_AT_ONCE = 128
#: Pieces up to so many characters are remembered, so many of them for each worker.
CACHE_CHARS, CACHE_PIECES = 48, 400_000

# The tokenizer's split pattern, within characters that its normalizer leaves
# whole or lower-cases one by one. Texts with any other character take the library's own path.
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
PLAIN = "[\t-\r\x20-\x7e\xa0-įı-ſ‐-‧‰-⁞€]*"
# Letters come first: the kinds start with different characters, but for short forms and other signs.
PIECES = f"[{_LETTERS}]+|[{_DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{_LETTERS}{_DIGITS}]+"
ASCII_PIECES = r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9]+"


class WordEncoder:
    """Ids of a word-level BPE file: pieces are encoded once by the library's model and remembered as packed ids."""

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.plain, self.pieces, self.ascii = re.compile(PLAIN), re.compile(PIECES), re.compile(ASCII_PIECES)
        model, letters = self.whole.model, {b: c for c, b in byte_letters().items()}

        class Known(dict):
            def __missing__(self, piece: str) -> bytes:
                form = piece if piece.isascii() else "".join(letters[b] for b in piece.encode())
                ids = np.array([t.id for t in model.tokenize(form)], dtype=np.int32).tobytes()
                if len(piece) <= CACHE_CHARS:
                    if len(self) >= CACHE_PIECES:
                        self.clear()
                    self[piece] = ids
                return ids

        self.known = Known()

    def encode(self, text: str) -> np.ndarray:
        if self.plain.fullmatch(text) is None or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        pieces = (self.ascii if text.isascii() else self.pieces).findall(text.lower())
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), dtype=np.int32)


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    return WordEncoder(path)


def tokenised(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID, limit: int = LIMIT) -> DataFrame:
    """(doc_id, ids, part, rest, place, first_full, full): ids with the end token, and places among equal lengths.

    ``rest`` is the length beyond ``full`` whole sequences, ``place`` its number among the
    rests of that length that this task (``part``) made, ``first_full`` the whole sequences
    made before. To be written before use: the places belong to one run of the task.
    """
    path = path or public_path(TOKENIZER)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType(
        [T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
        + [T.StructField(c, T.LongType()) for c in ("part", "rest", "place", "first_full", "full")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        seen, full = [0] * limit, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                lists, rests, places, firsts, fulls = [], [], [], [], []
                for x in some.column(1).to_pylist():
                    ids = np.append(enc.encode(x or ""), np.int32(end_id))
                    rest = len(ids) % limit
                    lists.append(ids)
                    rests.append(rest)
                    places.append(seen[rest])
                    firsts.append(full)
                    fulls.append(len(ids) // limit)
                    seen[rest] += 1
                    full += fulls[-1]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in lists])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists), type=pa.int32()))
                numbers = [pa.array(c, type=pa.int64()) for c in ([part] * len(lists), rests, places, firsts, fulls)]
                yield pa.RecordBatch.from_arrays([some.column(0), ids, *numbers], names=schema.names)

    return rows.mapInArrow(run, schema)


class Plan:
    """Where the rests of each length go: filled groups of packs, and cuts whose tails are rests again.

    Entries are kept by (length, first rank): ``count`` rests from that rank on lie at
    ``offset`` of as many packs from ``pack`` on; of each, ``take`` tokens. A tail has the
    length left and ranks from ``tail`` on.
    """

    def __init__(self, histogram: dict[int, int], limit: int = LIMIT):
        self.limit = limit
        left = [0] * limit
        for length, n in histogram.items():
            if not 0 < length < limit or n < 0:
                raise ValueError("lengths lie below the limit")
            left[length] = n
        total = sum(length * n for length, n in enumerate(left))
        unopened, spare = divmod(total, limit)
        opened = unopened
        # Groups of packs of one pattern: (room, first pack, fill, packs), most room first.
        groups: list[tuple[int, int, int, int]] = []
        for bit in reversed(range(spare.bit_length())):
            if spare >> bit & 1:
                groups.append((-(1 << bit), opened, 0, 1))
                opened += 1
        heapq.heapify(groups)
        self.packs, first_new = opened, 0
        rows: list[tuple[int, int, int, int, int, int]] = []

        def fill(group: tuple[int, int, int, int], used: int, take: int) -> None:
            room, pack, offset, packs = group
            if used < packs:
                heapq.heappush(groups, (room, pack + used, offset, packs - used))
            if room + take < 0:
                heapq.heappush(groups, (room + take, pack, offset + take, used))

        for length in range(limit - 1, 0, -1):
            rank, n = 0, left[length]
            while rank < n:
                if groups and -groups[0][0] >= length:
                    group, take = heapq.heappop(groups), length
                elif unopened:
                    group, take = (-limit, first_new, 0, min(unopened, n - rank)), length
                    first_new, unopened = first_new + group[3], unopened - group[3]
                else:
                    group = heapq.heappop(groups)
                    take = -group[0]
                used, tail = min(n - rank, group[3]), -1
                if take < length:
                    tail = left[length - take]
                    left[length - take] += used
                rows.append((length, rank, take, group[1], group[2], tail))
                fill(group, used, take)
                rank += used
        assert not groups and not unopened
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)
        self.codes = self.code(table[:, 0], table[:, 1])
        self.first, self.take, self.pack, self.offset, self.tail = table[:, 1], table[:, 2], table[:, 3], table[:, 4], table[:, 5]

    @staticmethod
    def code(length, rank) -> np.ndarray:
        return (np.asarray(length, dtype=np.int64) << 48) + rank

    def pieces(self, length: np.ndarray, rank: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Rounds of (row, start, length, pack, offset): the first piece of every rest, then the tails of cut ones."""
        row, start, out = np.arange(len(length)), np.zeros(len(length), dtype=np.int64), []
        length, rank = np.asarray(length, dtype=np.int64), np.asarray(rank, dtype=np.int64)
        while len(row):
            at = np.searchsorted(self.codes, self.code(length, rank), side="right") - 1
            into = rank - self.first[at]
            out.append((row, start, self.take[at], self.pack[at] + into, self.offset[at]))
            cut = self.take[at] < length
            row, start, length, rank = row[cut], (start + self.take[at])[cut], (length - self.take[at])[cut], (self.tail[at] + into)[cut]
        return out


def ranked(tokens: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, dict[int, int], int]:
    """Rows with ``rank_from`` and ``full_from`` of their part, the histogram of rests, and the number of whole sequences.

    Ranks are a part's running count before plus the place inside it: the ids are joined
    with narrow counts by (part, length), so a length that a third of the documents have is
    as many groups as there are parts. They are written first, so Spark knows their size and
    broadcasts them where they are small. The histogram has at most ``limit`` rows.
    """
    counts = tokens.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum("full").alias("full"))
    full = counts.groupBy("part").agg(F.sum("full").alias("n")).select("part", F.lit(limit).cast("long").alias("rest"), "n")
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select("part", "rest", "n").unionAll(full).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = sums.where(F.col("rest") < limit).select("part", "rest", F.col("before").alias("rank_from"))
    offsets = offsets.join(sums.where(F.col("rest") == limit).select("part", F.col("before").alias("full_from")), "part")
    found = {r.rest: r.n for r in sums.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    whole = found.pop(limit, 0)
    found.pop(0, None)
    return tokens.join(written(offsets)[0], ["part", "rest"]), found, whole


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of ``limit`` tokens, with no padding.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and ``ids`` on
    request. The last few sequences may be shorter: each of another power of two. The
    ids are made once and written to the shared folder; the plan that tasks carry has a
    row a (length, pattern), bounded by the limit and not by the documents.
    """
    tokens, _ = written(tokenised(docs, key, text, path, end_id, limit))
    rows, histogram, whole = ranked(tokens, limit)
    plan = Plan(histogram, limit)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [T.StructField("doc_id", tokens.schema["doc_id"].dataType), *[T.StructField(c, T.LongType()) for c in names]]
    schema = T.StructType(fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))
    order = ["doc_id", "ids", "rest", "place", "first_full", "rank_from", "full_from"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                rest, place, first, rank_from, full_from = (some.column(i).to_numpy(zero_copy_only=False) for i in range(2, 7))
                lists = some.column(1)
                bounds = lists.offsets.to_numpy().astype(np.int64)
                values = lists.values.to_numpy(zero_copy_only=False)
                size = np.diff(bounds)
                whole_of = size // limit
                row = np.repeat(np.arange(len(size)), whole_of)
                turn = np.arange(len(row)) - np.repeat(np.cumsum(whole_of) - whole_of, whole_of)
                parts = [(row, turn * limit, np.full(len(row), limit), (full_from + first)[row] + turn, np.zeros(len(row), dtype=np.int64))]
                open_rows = np.flatnonzero(rest > 0)
                for r, start, length, pack, offset in plan.pieces(rest[open_rows], (rank_from + place)[open_rows]):
                    r = open_rows[r]
                    parts.append((r, whole_of[r] * limit + start, length, pack + whole, offset))
                row, start, length, pack, offset = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
                begin = bounds[row] + start
                pieces = [values[a : a + n] for a, n in zip(begin.tolist(), length.tolist())]
                sums = [zlib.crc32(p.astype("<u4").tobytes()) for p in pieces]
                columns = [some.column(0).take(pa.array(row)), *[pa.array(c, type=pa.int64()) for c in (start, length, sums, size[row], pack, offset)]]
                if with_ids:
                    columns.append(pa.array([p.tolist() for p in pieces], type=pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select(*order).mapInArrow(run, schema)


def sequences(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(sequence_id, ids, doc_starts): the sequences of pieces that carry their ids; a group is one sequence."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(ordered.alias("p"))
    return grouped.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.offset").alias("doc_starts"))
