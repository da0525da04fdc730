"""Source divergence audit: how far the word use of the sources of a language lies apart.

A term's counts by source are a sparse column. Most terms share theirs with others, so
terms are grouped by the identical column, every pair of sources is evaluated once for
each distinct column, and the result is multiplied by the number of terms that have it.
Only the report of single terms goes back to the terms themselves.

Terms are runs of ASCII letters and of characters beyond ASCII, with A-Z lower-cased; a
language keeps those in enough of its documents. Shares are integers (see ``share``),
and so are all sums: results do not depend on the order of rows.

Defined results: NULL text, language or source is the empty string; a group whose
documents have no kept term, or no term at all, has counts of zero everywhere; a
language with one source has no pairs; repeated rows are documents of their own; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import checkpointed

MIN_DOCUMENTS, TOP_TERMS = 10, 10
#: Whole of the shares, and what is added to a count.
SCALE, ADDED = 1_000_000_000, 2
#: Counted terms a worker holds before it passes them on; columns and sources of one group.
HELD_TERMS, COLUMNS_AT_ONCE, SOURCES_AT_ONCE = 200_000, 20_000, 128
#: Columns evaluated at once inside a group.
BLOCK = 512

#: In UTF-8 every byte of a character beyond ASCII is 128 or more, and lower() of bytes changes A-Z alone.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
GROUP = ["lang", "source"]


def counted_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, merged in the task, then shuffled once by language and term.

    So all sources of a term meet in one task, and ``term_columns`` shuffles nothing again.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[tuple[str, str], Counter] = defaultdict(Counter)
        holding: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in count.items():
                have = holding[lang, source]
                words = pa.array(terms, type=pa.binary()).cast(pa.string())
                same = [pa.repeat(pa.scalar(c, pa.string()), len(terms)) for c in (lang, source)]
                yield pa.RecordBatch.from_arrays([*same, words, pa.array(terms.values(), type=pa.int64()), pa.array(map(have.__getitem__, terms), type=pa.int64())], names=names)
            count.clear()
            holding.clear()

        for batch in batches:
            held = 0
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                found = _TERM.findall(text.as_py().lower())
                key = lang, source
                before = len(count[key])
                # Counting a list, or a set, is one loop in C; adding one Counter to another is not.
                count[key].update(found)
                holding[key].update(set(found))
                held += len(count[key]) - before
                if held > HELD_TERMS:
                    yield from out()
                    held = 0
            yield from out()

    parts = docs.select(*map(empty, (*GROUP, "text"))).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def term_columns(counts: DataFrame, least: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, total, counts): kept terms and their sparse column of (source, n), in order of source."""
    grouped = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return grouped.where(F.col("docs") >= least).drop("docs")


def group_sizes(docs: DataFrame, columns: DataFrame) -> DataFrame:
    """(lang, source, total, vocabulary): every occurring group; occurrences of kept terms, and how many the language keeps."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(*map(empty, GROUP)).distinct()
    sums = columns.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("total"))
    kept = columns.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return groups.join(sums, GROUP, "left").join(kept, "lang", "left").select(*GROUP, zero("total"), zero("vocabulary"))


def share(n: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * vocabulary)), exact for any count."""
    exact = (n.cast("decimal(19,0)") + F.lit(ADDED)) * F.lit(SCALE)
    return F.call_function("div", exact, total.cast("decimal(19,0)") + vocabulary * F.lit(ADDED)) + F.lit(1)


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares; below 2^63, as shares are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(n: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """``share`` in numpy; whole numbers of Python where 64 bits would not hold the product."""
    whole = total + ADDED * vocabulary
    if len(n) and int(n.max()) + ADDED > (1 << 63) // SCALE:
        return np.array([1 + SCALE * (int(x) + ADDED) // whole for x in n], dtype=np.int64)
    return 1 + SCALE * (n + ADDED) // whole


def _tile(left: list[tuple], right: list[tuple], columns: pd.DataFrame, vocabulary: int) -> np.ndarray:
    """Summed distances of a tile of sources by a tile of sources, over distinct columns times their terms."""
    sums = np.zeros((len(left), len(right)), dtype=np.int64)
    places = [{s: i for i, (s, _) in enumerate(side)} for side in (left, right)]
    listed = columns["counts"].tolist()
    times = columns["terms"].to_numpy(dtype=np.int64)
    for at in range(0, len(listed), BLOCK):
        some = listed[at : at + BLOCK]
        dense = [np.zeros((len(side), len(some)), dtype=np.int64) for side in (left, right)]
        for j, column in enumerate(some):
            for entry in column:
                for place, counts in zip(places, dense):
                    i = place.get(entry["source"])
                    if i is not None:
                        counts[i, j] = entry["n"]
        p, q = (np.stack([_shares(c, total, vocabulary) for c, (_, total) in zip(counts, side)]) for counts, side in zip(dense, (left, right)))
        weight = times[at : at + BLOCK]
        for i in range(len(left)):
            gap = p[i] - q
            sums[i] += ((gap * gap // (p[i] + q)) * weight).sum(1)
    return sums


def pair_sums(columns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value): summed distance of each two sources of a language that keeps a term.

    Distinct columns are dealt to groups of about COLUMNS_AT_ONCE, and sources to tiles of
    SOURCES_AT_ONCE, so neither a language with a third of all terms nor one with very many
    sources is one task. A group returns one row for each pair of its tile.
    """
    distinct = checkpointed(columns.groupBy("lang", "counts").agg(F.count("*").alias("terms")))
    deals = distinct.groupBy("lang").agg(F.ceil(F.count("*") / COLUMNS_AT_ONCE).cast("int").alias("deals"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    tiled = sizes.where("vocabulary > 0").withColumn("tile", F.floor(place / SOURCES_AT_ONCE).cast("int"))
    tiles = tiled.groupBy("lang", "tile", "vocabulary").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("sources"))
    named = lambda c: tiles.select("lang", F.col("tile").alias(f"{c}_tile"), F.col("sources").alias(c))
    # Each unordered pair of tiles once for every deal: as many rows as groups to work on.
    pairs = named("first").join(named("second"), "lang").where("first_tile <= second_tile").join(tiles.select("lang", "vocabulary").distinct(), "lang")
    work = pairs.join(deals, "lang").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
    asked = work.select("lang", "deal", "first_tile", "second_tile").groupBy("lang", "deal").agg(F.collect_set(F.struct("first_tile", "second_tile")).alias("tiles"))
    dealt = distinct.join(deals, "lang").withColumn("deal", F.pmod(F.xxhash64("counts"), F.col("deals")).cast("int")).drop("deals")
    copies = dealt.join(asked, ["lang", "deal"]).withColumn("t", F.explode("tiles")).select("lang", "deal", "t.*", "counts", "terms")
    key = ["lang", "deal", "first_tile", "second_tile"]

    def rows_of(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["lang", "source", "item", "value"]).astype({"lang": object, "source": object, "item": object, "value": "int64"})

    def run(part: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
        if part.empty or tile.empty:
            return rows_of([])
        row = tile.iloc[0]
        left, right = ([(s["source"], int(s["total"])) for s in row[side]] for side in ("first", "second"))
        sums = _tile(left, right, part, int(row["vocabulary"]))
        same = row["first_tile"] == row["second_tile"]
        rows = []
        for i, (a, _) in enumerate(left):
            for j, (b, _) in enumerate(right):
                if not same or i < j:
                    rows += [(row["lang"], a, b, int(sums[i, j])), (row["lang"], b, a, int(sums[i, j]))]
        return rows_of(rows)

    parts = copies.groupBy(*key).cogroup(work.groupBy(*key)).applyInPandas(run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def ranked(rows: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", place.cast("int"))


def pair_report(columns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language, the farthest first."""
    names = sizes.select(*GROUP)
    every = names.join(names.select("lang", F.col("source").alias("item")), "lang").where(F.col("source") != F.col("item"))
    found = every.join(pair_sums(columns, sizes), [*GROUP, "item"], "left")
    return ranked(found.select(*GROUP, "item", F.coalesce("value", F.lit(0)).alias("value")))


def term_report(columns: DataFrame, sizes: DataFrame, most: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source uses most beyond its language."""
    whole = sizes.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    used = columns.select("lang", F.col("term").alias("item"), F.col("total").alias("lang_n"), F.explode("counts").alias("c")).select("lang", "item", "lang_n", "c.source", "c.n")
    joined = used.join(sizes.join(whole, "lang"), GROUP)
    p, q = share(F.col("n"), F.col("total"), F.col("vocabulary")), share(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary"))
    over = joined.select(*GROUP, "item", p.alias("p"), q.alias("q")).where("p > q")
    return ranked(over.select(*GROUP, "item", distance(F.col("p"), F.col("q")).alias("value"))).where(F.col("rank") <= most)


def audit(docs: DataFrame, least: int = MIN_DOCUMENTS, most: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): both reports of documents (text, lang, source)."""
    columns = checkpointed(term_columns(counted_terms(docs), least))
    sizes = checkpointed(group_sizes(docs, columns))
    kind = lambda df, name: df.select(*GROUP, F.lit(name).alias("part"), "item", "value", "rank")
    return kind(pair_report(columns, sizes), "pair").unionAll(kind(term_report(columns, sizes, most), "term"))


_P = "1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v)"
_F = "CAST((p - q) * (p - q) // (p + q) AS BIGINT)"
#: The same in SQL: every group with every kept term.
ORACLE = rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS MATERIALIZED (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM w GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS MATERIALIZED (SELECT lang, source, coalesce(t, 0) AS t, coalesce(v, 0) AS v, coalesce(lt, 0) AS lt FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS t FROM c GROUP BY 1, 2) USING (lang, source) LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS lt FROM kept GROUP BY 1) USING (lang)),
s AS MATERIALIZED (SELECT lang, source, term, coalesce(n, 0) AS n, {_P.format(n="coalesce(n, 0)", total="t")} AS p FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT lang, source, item, sum({_F}) AS value FROM (SELECT x.lang, x.source, y.source AS item, x.p, y.p AS q FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source) GROUP BY 1, 2, 3) m
  ON m.lang = a.lang AND m.source = a.source AND m.item = b.source),
terms AS (SELECT lang, source, term AS item, {_F} AS value FROM (SELECT s.lang, s.source, s.term, s.n, s.p, {_P.format(n="total", total="lt")} AS q FROM s JOIN kept USING (lang, term) JOIN g USING (lang, source)) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM terms) WHERE rank <= 10"""
