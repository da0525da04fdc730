"""Fill-in-the-middle transformation by an Aho-Corasick scan of events.

One automaton holds the sentinels and the ASCII characters that start and end units
(the class-changing ones); its matches are the events of a text. Between two events
nothing changes, so a gap has as many units as it has characters, or one where a run is
a unit. The event table is sparse, and the character at any unit rank is found in it by
bisection. Units of single code points change at no character, so their events are the
sentinels alone.

Defined results: a NULL text is an empty one; empty texts and texts with a sentinel are
plain; NULL keys draw as one key, so repeated rows are cut alike; texts of any length
are cut whole; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import key_text

#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Per cent of texts that are cut, and of these in the order suffix, prefix, middle.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
#: Unit kinds: the ASCII characters that are units of their own, and whether a run between them is one unit.
UNITS = {"code_point": ("", False), "word": ("\t\n\x0b\x0c\r ", True), "line": ("\n", True)}


class Events:
    """Events of one text: where units change, and whether a sentinel stands in it."""

    def __init__(self, text: str, scanner: Scanner):
        self.size, self.runs = len(text), scanner.runs
        #: Start of each event, and units before it.
        self.starts: list[int] = []
        self.before: list[int] = []
        self.sentinel = False
        units = at = 0
        for end, sentinel in scanner.automaton.iter(text):
            if sentinel:
                self.sentinel = True
                continue
            units += self._gap(end - at)
            self.starts.append(end)
            self.before.append(units)
            units, at = units + 1, end + 1
        self.units = units + self._gap(self.size - at)

    def _gap(self, length: int) -> int:
        return min(length, 1) if self.runs else length

    def place(self, rank: int) -> int:
        """Index of the first character of unit ``rank``; the text's end for the rank after the last."""
        if rank >= self.units:
            return self.size
        i = bisect_right(self.before, rank) - 1
        start, first = (self.starts[i], self.before[i]) if i >= 0 else (-1, -1)
        into = rank - first
        # The event itself is one unit, then the gap behind it: one unit, or one a character.
        return start if into == 0 else start + into


class Scanner:
    """The automaton of one kind of unit and one set of sentinels."""

    def __init__(self, unit: str, sentinels: Sequence[str]):
        import ahocorasick

        breaks, self.runs = UNITS[unit]
        self.automaton = ahocorasick.Automaton()
        for c in breaks:
            self.automaton.add_word(c, False)
        for s in sentinels:
            if len(s) < 2:
                raise ValueError("a sentinel has two characters or more")
            self.automaton.add_word(s, True)
        self.automaton.make_automaton()
        self.marks = ahocorasick.Automaton()
        for i, s in enumerate(sentinels):
            self.marks.add_word(s, (i, len(s)))
        self.marks.make_automaton()


@lru_cache(maxsize=8)
def scanner(unit: str, sentinels: tuple[str, ...]) -> Scanner:
    return Scanner(unit, sentinels)


def draws(key: str, seed: int) -> list[int]:
    """Four unsigned numbers of 32 bits from the digest of seed and key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, key: str, seed: int, unit: str, sentinels: tuple[str, str, str]) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    events = Events(text, scanner(unit, sentinels))
    one, two, three, four = draws(key, seed)
    n = events.units
    if not text or events.sentinel or three % 100 >= CUT_PERCENT:
        return n, "plain", None, None, text
    low, high = sorted((one % (n + 1), two % (n + 1)))
    a, b = events.place(low), events.place(high)
    before, after, middle = sentinels
    if four % 100 < SUFFIX_FIRST_PERCENT:
        return n, "spm", a, b - a, f"{after}{text[b:]}{before}{text[:a]}{middle}{text[a:b]}"
    return n, "psm", a, b - a, f"{before}{text[:a]}{after}{text[b:]}{middle}{text[a:b]}"


def rebuilt(output: str, form: str, sentinels: tuple[str, str, str]) -> str:
    """The text before the transformation, from the sentinels that the automaton finds."""
    if form == "plain":
        return output
    spots: dict[int, tuple[int, int]] = {}
    for end, (which, length) in scanner("code_point", sentinels).marks.iter(output):
        spots.setdefault(which, (end + 1 - length, end + 1))
    ordered = sorted(spots.items(), key=lambda s: s[1])
    stops = [start for _, (start, _) in ordered[1:]] + [len(output)]
    part = {which: output[end:stop] for (which, (_, end)), stop in zip(ordered, stops, strict=True)}
    return part[0] + part[2] + part[1]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, unit: str = "code_point", sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): every text with its parts in another order."""

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, keys in parts:
            rows = [transform(t or "", k, seed, unit, sentinels) for t, k in zip(texts, keys, strict=True)]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return docs.select(F.col(key).alias("doc_id"), run(F.col(text), key_text(F.col(key))).alias("m")).select("doc_id", "m.*")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The texts behind a column of outputs and their forms."""

    @F.pandas_udf("string")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in parts:
            yield pd.Series([rebuilt(o, f, sentinels) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return run(output, form)


#: The same in SQL, for units of single code points.
ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '\N')) AS h FROM documents),
r AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1, n - b) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
