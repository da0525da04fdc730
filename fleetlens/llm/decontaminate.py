"""Benchmark decontamination by edit distance over words.

CGK random walks (Chakraborty, Goldenberg and Koucky 2016) map the edit distance of
two word sequences to Hamming distance; repeated samples of embedded positions are
the keys of a hash index of the items, and windows of an item's size are looked up
in it (as in EmbedJoin, Zhang and Zhang 2017). Every hit is verified by an exact
edit distance. Windows are hashed where they can match at all: ``k`` edits destroy
at most ``2 k`` of an item's word pairs, so a window with fewer of them, or fewer
different ones, is skipped without loss. Walks fall out of step as items grow, so items of more than WALK_WORDS
words have no walks: every window that the pairs leave is verified. Each occurrence of
an item is a match of its own; occurrences of one item do not overlap.

A document contains an item of n words if some run of its words is within
``floor(n * (1 - SIMILARITY))`` word edits of the item. Words are runs of letters,
digits and non-ASCII characters, in lower case. Items of fewer than MIN_WORDS words allow
no edit and are looked up as they are. ``without_leaks``, which drops whole documents, leaves
these out unless told otherwise: one common word is no leak.

Defined results: a NULL or empty text contains nothing; items without words or with a
NULL id never match; ids may be of any type; items with equal
texts all match; repeated rows match alike; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import serving

SIMILARITY = 0.8
#: Least words of an item that an edit leaves recognisable; shorter ones are compared exactly.
MIN_WORDS = 5
#: Embeddings, and positions sampled from each: recall over 0.99 at the threshold (tested).
REPEATS, SAMPLED = 24, 2
#: Words up to which an item is looked up by its walks.
WALK_WORDS = 63
#: Items of one pass over the documents; more items take more passes.
ITEMS_A_PASS = 20_000

_BREAKS = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
MATCH = "array<struct<item_id:{},start_word:int,end_word:int,distance:int>>"


def split_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BREAKS).split()


def edits_allowed(n: int) -> int:
    return int(n * (1 - SIMILARITY) + 1e-9)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Walks:
    """The random bits of all walks over one vocabulary; rebuilt where it is unpickled."""

    def __init__(self, words: int, longest: int):
        self.words, self.longest = words, longest
        self._bits: list[np.ndarray] = []

    def __getstate__(self):
        return {"words": self.words, "longest": self.longest, "_bits": []}

    def _make(self) -> None:
        word = np.arange(self.words + 2, dtype=np.uint64)[:, None]
        turn = np.arange(REPEATS, dtype=np.uint64)[None, :]
        with np.errstate(over="ignore"):
            seed = _mix(word * np.uint64(0x9E3779B97F4A7C15) + turn * np.uint64(0xD1B54A32D192ED03))
            self._bits = [(_mix(seed + np.uint64(j + 1)) & np.uint64(1)).astype(np.uint8).ravel() for j in range(_last_step(self.longest) + 1)]

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """Keys of word-id windows (rows of one length): one for each repeat.

        Walk: output the word at the cursor, then advance by a random bit of (repeat,
        step, word). Sampled steps lie where most walks are still inside the window.
        """
        if not self._bits:
            self._make()
        count, n = windows.shape
        steps = np.random.default_rng(n).integers(0, _last_step(n) + 1, size=(REPEATS, SAMPLED))
        # Repeats by their last sampled step, so that those still walking are the first columns.
        order = np.argsort(-steps.max(axis=1), kind="stable")
        steps = steps[order]
        last = steps.max(axis=1)
        pad = self.words + 1
        padded = np.concatenate([np.where(windows < 0, self.words, windows), np.full((count, 1), pad, dtype=np.int64)], axis=1).ravel()
        stop = (np.arange(1, count + 1, dtype=np.int64) * (n + 1) - 1)[:, None]
        at = np.repeat(stop - n, REPEATS, axis=1)
        taken = np.empty((count, REPEATS, SAMPLED), dtype=np.uint64)
        for j in range(int(last[0]) + 1):
            walking = int(np.searchsorted(-last, -j, side="right"))
            at = at[:, :walking]
            word = padded.take(at)
            r, s = np.nonzero(steps[:walking] == j)
            if len(r):
                taken[:, r, s] = word[:, r]
            word *= REPEATS
            word += order[:walking]
            at = np.minimum(at + self._bits[j].take(word), stop)
        keys = np.broadcast_to(order.astype(np.uint64) + np.uint64(1), (count, REPEATS))
        with np.errstate(over="ignore"):
            for s in range(SAMPLED):
                keys = _mix(keys * np.uint64(0x100000001B3) + taken[:, :, s] + np.uint64(1))
        return keys


def _last_step(n: int) -> int:
    return max(1, int(1.6 * n)) - 1


def best_fit(item: list[int], words: list[int]) -> tuple[int, int, int]:
    """Least edits of ``item`` against any run of ``words``: (edits, start, end)."""
    cost = [(i, 0) for i in range(len(item) + 1)]
    best = (cost[-1][0], 0, 0)
    for j, w in enumerate(words, 1):
        last, cost[0] = cost[0], (0, j)
        for i, x in enumerate(item, 1):
            up, left, diagonal = cost[i], cost[i - 1], last
            last = up
            step = (diagonal[0] + (x != w), diagonal[1])
            if up[0] + 1 < step[0]:
                step = (up[0] + 1, up[1])
            if left[0] + 1 < step[0]:
                step = (left[0] + 1, left[1])
            cost[i] = step
        if cost[-1][0] < best[0]:
            best = (cost[-1][0], cost[-1][1], j)
    return best


def best_fit_long(item: list[int], words: list[int], allowed: int) -> tuple[int, int, int]:
    """``best_fit`` a column at a time; the shortest run that ends first. No places beyond ``allowed`` edits."""
    want, steps = np.array(item), np.arange(len(item) + 1)

    def columns(want: np.ndarray, words: list[int], free: int):
        cost = steps
        for j, w in enumerate(words, 1):
            new = np.concatenate([[free * j], np.minimum(cost[:-1] + (want != w), cost[1:] + 1)])
            cost = np.minimum.accumulate(new - steps) + steps
            yield j, int(cost[-1])

    edits, end = len(item), 0
    for j, c in columns(want, words, 0):
        if c < edits:
            edits, end = c, j
    if edits > allowed:
        return edits, 0, 0
    return edits, end - next((j for j, c in columns(want[::-1], words[:end][::-1], 1) if c == edits), 0), end


class ItemIndex:
    """Hash index of the items' embedded samples, with the word-pair filter in front."""

    def __init__(self, items: list[tuple[int, str | None]], shortest: int = 1):
        self.vocab: dict[bytes, int] = {}
        self.items: list[tuple[list[int], list[int]]] = []
        same: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for item_id, text in items:
            words = split_words(text)
            if item_id is not None and len(words) >= max(shortest, 1):
                same[tuple(self.vocab.setdefault(w, len(self.vocab)) for w in words)].append(item_id)
        self.items = [(list(words), sorted(ids)) for words, ids in sorted(same.items()) if len(words) >= MIN_WORDS]
        #: For each size under MIN_WORDS, the items by their words.
        self.short: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(dict)
        for words, ids in same.items():
            if len(words) < MIN_WORDS:
                self.short[len(words)][words] = sorted(ids)
        by_pair: dict[int, set[int]] = defaultdict(set)
        by_size: dict[int, list[int]] = defaultdict(list)
        for k, (words, _) in enumerate(self.items):
            if len(words) <= WALK_WORDS:
                by_size[len(words)].append(k)
            for a, b in zip(words, words[1:]):
                by_pair[(a << 32) | b].add(k)
        self.pairs = np.array(sorted(by_pair), dtype=np.int64)
        # The items of pair p are pair_items[pair_from[p] : pair_from[p + 1]].
        self.pair_items = np.array([k for p in self.pairs.tolist() for k in sorted(by_pair[p])], dtype=np.int64)
        self.pair_from = np.cumsum([0, *(len(by_pair[p]) for p in self.pairs.tolist())])
        sizes = np.array([len(words) for words, _ in self.items], dtype=np.int64)
        self.need = np.array([max(1, n - 1 - 2 * edits_allowed(n)) for n in sizes.tolist()], dtype=np.int64)
        kinds = np.bincount(self.pair_items, minlength=len(sizes)).tolist()
        self.need_kinds = np.array([max(1, d - 2 * edits_allowed(n)) for d, n in zip(kinds, sizes.tolist())], dtype=np.int64)
        self.walks = Walks(len(self.vocab), max(by_size, default=1))
        #: For each size, the keys in order and the item of each.
        self.table: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, members in by_size.items():
            keys = self.walks.keys(np.array([self.items[k][0] for k in members], dtype=np.int64)).ravel()
            order = np.argsort(keys, kind="stable")
            self.table[n] = keys[order], np.repeat(np.array(members), REPEATS)[order]

    def matches(self, text: str | None) -> list[tuple]:
        """(item id, first word, word after the last, edits) of every occurrence of every item."""
        words = split_words(text)
        if not words or not self.vocab:
            return []
        get = self.vocab.get
        ids = np.array(list(map(get, words, repeat(-1))), dtype=np.int64)
        return sorted(self._short_ones(ids) + self._long_ones(ids), key=lambda m: (str(m[0]), m[1:]))

    def _short_ones(self, ids: np.ndarray) -> list[tuple]:
        """Occurrences of items of fewer than MIN_WORDS words, from left to right, without overlaps of one item."""
        out = []
        for n, items in self.short.items():
            done: dict[tuple[int, ...], int] = {}
            begins = np.isin(ids[: max(0, len(ids) - n + 1)], np.array(sorted({words[0] for words in items})))
            for p in np.flatnonzero(begins).tolist():
                words = tuple(ids[p : p + n].tolist())
                if words in items and p >= done.get(words, 0):
                    done[words] = p + n
                    out += [(i, p, p + n, 0) for i in items[words]]
        return out

    def _long_ones(self, ids: np.ndarray) -> list[tuple]:
        """Occurrences of all other items, in no order."""
        if len(ids) < MIN_WORDS - 1 or not self.items:
            return []
        both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        if not len(both):
            return []
        codes = (ids[both] << 32) | ids[both + 1]
        where = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        hit = self.pairs[where] == codes
        at, which = both[hit], where[hit]
        if len(at) < (MIN_WORDS - 1) - 2 * edits_allowed(MIN_WORDS):
            return []
        # Every place of a pair once for each item that has the pair, grouped by item, places in order.
        many = self.pair_from[which + 1] - self.pair_from[which]
        begin = np.cumsum(many) - many
        item_of = self.pair_items[np.arange(int(many.sum())) + np.repeat(self.pair_from[which] - begin, many)]
        order = np.argsort(item_of, kind="stable")
        item_of, at, which = item_of[order], np.repeat(at, many)[order], np.repeat(which, many)[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(item_of)) + 1, [len(item_of)]])
        enough = np.flatnonzero(np.diff(cuts) >= self.need[item_of[cuts[:-1]]])
        open_at: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
        for c in enough.tolist():
            k = int(item_of[cuts[c]])
            starts = self._starts(k, at[cuts[c] : cuts[c + 1]], which[cuts[c] : cuts[c + 1]])
            if len(starts):
                open_at[len(self.items[k][0])][k] = starts
        out = []
        for n, starts in open_at.items():
            found = starts if n > WALK_WORDS else self._met(n, ids, starts)
            for k, places in found.items():
                out += [(i, *o) for o in self._occurrences(k, ids, places) for i in self.items[k][1]]
        return out

    def _starts(self, k: int, hits: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Starts p whose window [p, p + n + allowed) has enough pairs of item ``k``, and enough different ones.

        ``hits`` are the places of its pairs, ``kinds`` tells which pair stands there.
        """
        n, need = len(self.items[k][0]), int(self.need[k])
        low = np.maximum(hits[need - 1 :] - (n + edits_allowed(n)) + 1, 0)
        high = hits[: len(hits) - need + 1]
        fits = low <= high
        low, high = low[fits], high[fits]
        if not len(low):
            return low
        # Both bounds rise, so each interval begins after the one before.
        low = np.maximum(low, np.concatenate([[0], high[:-1] + 1]))
        size = np.maximum(high - low + 1, 0)
        starts = np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size)
        # Of these, the ones with enough different pairs: a pair counts where it stands first in the window.
        order = np.argsort(kinds, kind="stable")
        again = kinds[order[1:]] == kinds[order[:-1]]
        before = np.full(len(hits), -1, dtype=np.int64)
        before[order[1:][again]] = hits[order[:-1][again]]
        new = np.zeros(len(starts), dtype=np.int64)
        at = np.searchsorted(hits, starts)
        end = np.searchsorted(hits, starts + (n + edits_allowed(n)))
        for _ in range(int((end - at).max(initial=0))):
            new += (at < end) & (before[np.minimum(at, len(hits) - 1)] < starts)
            at += 1
        return starts[new >= self.need_kinds[k]]

    def _met(self, n: int, ids: np.ndarray, starts: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """For each item of ``n`` words, those of its starts whose window shares a key with it.

        A window that several items ask for is walked once.
        """
        ext = np.concatenate([ids, np.full(n, -1, dtype=np.int64)])
        keys_in_order, items = self.table[n]
        asked = np.unique(np.concatenate(list(starts.values())))
        met: list[np.ndarray] = []
        for i in range(0, len(asked), 4096):
            block = asked[i : i + 4096]
            keys = self.walks.keys(ext[block[:, None] + np.arange(n)]).ravel()
            first = np.searchsorted(keys_in_order, keys)
            equal = np.flatnonzero(keys_in_order[np.minimum(first, len(items) - 1)] == keys)
            if len(equal):
                lo, hi = first[equal], np.searchsorted(keys_in_order, keys[equal], side="right")
                run = np.arange(int((hi - lo).sum())) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
                met.append(np.stack([items[run], np.repeat(block[equal // REPEATS], hi - lo)]))
        if not met:
            return {}
        pairs = np.concatenate(met, axis=1)
        return {k: p for k, s in starts.items() if len(p := np.intersect1d(pairs[1, pairs[0] == k], s))}

    def _occurrences(self, k: int, ids: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int]]:
        """(first word, word after the last, edits) of occurrences that do not overlap.

        Starts within an item's size of the first make one search; its best fit is taken,
        then what lies before it, then the starts after it. Each search is bounded by the
        item, so any number of copies costs time in proportion.
        """
        item = self.items[k][0]
        n, allowed = len(item), edits_allowed(len(item))
        out, done, i = [], 0, 0
        while i < len(places):
            p = int(places[i])
            j = int(np.searchsorted(places, p + n, side="right"))
            low, high = max(done, p - allowed), min(len(ids), int(places[j - 1]) + n + 2 * allowed)
            taken = None
            while high - low >= n - allowed:
                part = ids[low:high].tolist()
                exact = next((q for q in (places[i:j] - low).tolist() if q >= 0 and part[q : q + n] == item), None)
                if exact is not None:
                    edits, first, last = 0, exact, exact + n
                else:
                    edits, first, last = best_fit_long(item, part, allowed) if n > WALK_WORDS else best_fit(item, part)
                if edits > allowed:
                    break
                out.append((low + first, low + last, edits))
                taken = taken or low + last
                high = low + first
            if taken:
                done = taken
                i = max(i + 1, int(np.searchsorted(places, done - allowed)))
            else:
                i = j
        return sorted(out)


def match_column(index: ItemIndex, text: Column, id_type: str = "bigint") -> Column:
    """Contained items of every text, as array<struct<item_id,start_word,end_word,distance>>."""

    @F.pandas_udf(MATCH.format(id_type))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        serving("leaks")
        names = ("item_id", "start_word", "end_word", "distance")
        for part in parts:
            yield pd.Series([[dict(zip(names, m)) for m in index.matches(x)] for x in part], dtype=object)

    return run(text)


def _blocks(items: DataFrame, item_key: str, item_text: str, shortest: int = 1) -> Iterator[ItemIndex]:
    """Indexes of about ITEMS_A_PASS items each; there is one at least."""
    wanted = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t"))
    blocks = -(-wanted.count() // ITEMS_A_PASS) or 1
    for b in range(blocks):
        yield ItemIndex([(r.i, r.t) for r in wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()], shortest)


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> Column:
    """Column of all matches. One worker holds the indexes of all items: for benchmarks of bounded size."""
    kind = items.schema[item_key].dataType.simpleString()
    found = [match_column(index, docs[text], kind) for index in _blocks(items, item_key, item_text)]
    return found[0] if len(found) == 1 else F.flatten(F.array(*found))


def leak_rows(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, start_word, end_word, distance) of every match.

    Each block of items is a pass of its own over the documents, so the driver and a
    task hold one index of about ITEMS_A_PASS items at a time, however many there are.
    """
    kind = items.schema[item_key].dataType.simpleString()
    passes = [
        docs.select(F.col(key), F.explode_outer(match_column(index, docs[text], kind)).alias("_match")).where("_match is not null").select(key, "_match.*")
        for index in _blocks(items, item_key, item_text)
    ]
    return reduce(DataFrame.unionAll, passes)


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", shortest: int = MIN_WORDS) -> DataFrame:
    """Rows of ``docs`` whose text contains no item of ``shortest`` words or more, a filter for each block of items."""
    for index in _blocks(items, item_key, item_text, shortest):
        row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
        docs = docs.select(row, match_column(index, docs[text], items.schema[item_key].dataType.simpleString()).alias("leaks")).where(F.size("leaks") == 0).select("row.*")
    return docs
