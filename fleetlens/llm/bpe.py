"""Byte-level BPE by exact backtracking, and decoding from an offset table.

A text is cut by the pre-tokenizer's pattern; each piece is encoded by taking the
longest vocabulary entry that an Aho-Corasick automaton finds at a position and
going back to a shorter one where the pair with the token before it could not
stand side by side in a merged sequence. That check unfolds the merge tree of both
tokens against a table of merge pairs, so the result equals merging by rank while
the work stays linear in the piece (public description: "So many tokens, so little
time", GitHub Engineering, 2024).

Defined results: a NULL or empty text has no ids and decodes to the empty string;
special tokens written in a text become their ids; repeated rows encode alike;
other columns are never read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import serving

#: The byte-level pre-tokenizer's split.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces up to so many bytes are remembered, so many of them for each worker.
CACHE_BYTES, CACHE_PIECES = 48, 200_000
#: Token pairs a worker remembers the check of.
CACHE_PAIRS = 300_000


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 byte values in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        model = data["model"]
        vocab = {as_bytes(t): i for t, i in model["vocab"].items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # Internal numbers: bytes first, then merges by rank, so a greater number merges later.
        self.tokens = [bytes([b]) for b in range(256)]
        number = {t: i for i, t in enumerate(self.tokens)}
        self.left, self.right = list(range(256)), list(range(256))
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            a, b = as_bytes(a), as_bytes(b)
            if a + b in number:
                raise ValueError("two merges give one token: this encoder wants a token to have one pair")
            self.pairs[number[a], number[b]] = number[a + b] = len(self.tokens)
            self.left.append(number[a])
            self.right.append(number[b])
            self.tokens.append(a + b)
        self.ids = [vocab[t] for t in self.tokens]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = regex.compile(PIECES)
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t.decode("latin-1"), (len(t) - 1, i))
        self.automaton.make_automaton()
        # The longest token that is a proper prefix of each token, or -1.
        self.shorter = [-1] * len(self.tokens)
        for i, t in enumerate(self.tokens):
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in number:
                    self.shorter[i] = number[t[:n]]
                    break
        self.lengths = [len(t) for t in self.tokens]
        self.cache: dict[str, tuple[tuple[int, ...], str]] = {}
        self.checked: dict[int, bool] = {}
        size = 1 + max([*self.ids, *self.special.values()])
        parts: list[bytes] = [b""] * size
        for i, t in zip(self.ids, self.tokens, strict=True):
            parts[i] = t
        for t, i in self.special.items():
            parts[i] = t.encode()
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def fits(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` stays two tokens under merging by rank."""
        code = a << 20 | b
        known = self.checked.get(code)
        if known is None:
            if len(self.checked) >= CACHE_PAIRS:
                self.checked.clear()
            known = self.checked[code] = self._unfold(a, b)
        return known

    def _unfold(self, a: int, b: int) -> bool:
        pairs, left, right, limit = self.pairs, self.left, self.right, len(self.tokens)
        while True:
            joined = pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a > b:
                limit = a
                a = right[a]
                if a == limit:
                    limit = b + 1
                    b = left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit = b + 1
                b = left[b]
                if b + 1 == limit:
                    limit = a
                    a = right[a]
                    if a == limit:
                        return True

    def longest_at(self, text: str) -> list[int]:
        """The longest token that starts at each position, from one pass of the automaton.

        Matches come by end, so the last one seen for a start is the longest.
        """
        best = [-1] * len(text)
        for end, (before, token) in self.automaton.iter(text):
            best[end - before] = token
        return best

    def encode_piece(self, raw: bytes) -> tuple[int, ...]:
        """Internal tokens of one piece."""
        n = len(raw)
        best = self.longest_at(raw.decode("latin-1"))
        lengths, shorter, checked = self.lengths, self.shorter, self.checked
        token = best[0]
        if lengths[token] == n:
            return (token,)
        out: list[int] = []
        open_at = bytearray(b"\x01") * (n + 1)  # 0: no valid way on from here
        at, last = 0, -1
        while at < n:
            while True:
                end = at + lengths[token]
                if open_at[end]:
                    if last < 0:
                        break
                    fit = checked.get(last << 20 | token)
                    if fit is None:
                        fit = self.fits(last, token)
                    if fit:
                        break
                token = shorter[token]
                if token < 0:
                    break
            if token >= 0:
                out.append(token)
                last, at = token, end
                token = best[at] if at < n else -1
            else:
                # Nothing fits here: close the place and shorten the token before it.
                open_at[at] = 0
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1
        return tuple(out)

    def _learn(self, piece: str) -> tuple[tuple[int, ...], str]:
        raw = piece.encode()
        ids = tuple([self.ids[t] for t in self.encode_piece(raw)])
        known = ids, ",".join(map(str, ids))
        if len(raw) <= CACHE_BYTES:
            if len(self.cache) >= CACHE_PIECES:
                self.cache.clear()
            self.cache[piece] = known
        return known

    def _encoded(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """(ids, ids as decimal text) of each special token and piece of a text."""
        out: list = []
        special = self.split_special is not None and any(s in text for s in self.special)
        for i, part in enumerate(self.split_special.split(text) if special else [text]):
            if i % 2:
                out.append(((self.special[part],), str(self.special[part])))
                continue
            pieces = self.pieces.findall(part)
            known = list(map(self.cache.get, pieces))
            if None in known:
                known = [self._learn(p) if k is None else k for p, k in zip(pieces, known)]
            out += known
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable([ids for ids, _ in self._encoded(text)]))

    def encode_with_text(self, text: str) -> tuple[list[int], str]:
        """Ids, and their decimal forms joined by commas."""
        known = self._encoded(text)
        return list(chain.from_iterable([ids for ids, _ in known])), ",".join([form for _, form in known])

    def decode(self, ids) -> str:
        """Bytes of all ids gathered from the table in one step, as UTF-8."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return ""
        start, size = self.offsets[ids], np.diff(self.offsets)[ids]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        where = np.arange(int(size.sum()), dtype=np.int64) + np.repeat(start - first, size)
        return self.blob[where].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker process and file."""
    return Codec(path)


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_column(text, path: str | None = None):
    """Column of token ids (array<int>) of a text column."""
    path = path or public_path()

    @F.pandas_udf("array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        serving("bpe", codec.cache_clear)
        c = codec(path)
        for part in parts:
            yield pd.Series([np.asarray(c.encode(x or ""), dtype=np.int32) for x in part], dtype=object)

    return run(text)


def decode_column(ids, path: str | None = None):
    """Column of texts of a column of token ids; NULL gives the empty string."""
    path = path or public_path()

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        serving("bpe", codec.cache_clear)
        c = codec(path)
        for part in parts:
            yield pd.Series([c.decode(x) if x is not None else "" for x in part], dtype=object)

    return run(ids)


def round_trip_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: key, n_tokens, SHA-256 of the ids and of the decoded text.

    Ids are digested where they are made, so they never travel back to the JVM.
    """
    path = path or public_path()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        serving("bpe", codec.cache_clear)
        c = codec(path)
        for part in parts:
            rows = []
            for x in part:
                ids, form = c.encode_with_text(x or "")
                rows.append((len(ids), hashlib.sha256(form.encode()).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(key).alias("doc_id"), run(F.col(text)).alias("d")).select("doc_id", "d.*")
