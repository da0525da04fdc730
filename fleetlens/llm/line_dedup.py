"""Removal of boilerplate lines that spread over many sites.

Each line of a document is keyed by the MD5 of its trimmed text. One aggregate over all
lines merges a sketch of sites, HyperLogLog, for each line, so no table of lines and
sites is made. Lines whose estimate is within six standard errors of the threshold (at
least one site) get an exact distinct count of sites; estimates decide the others. A line found on ``min_sites`` sites or more is boilerplate: its
first document (least key) keeps it, all others lose it, so no passage leaves the
corpus and groups of copies keep one carrier.

Defined results: a NULL text has no lines, stays NULL and loses none; blank lines always stay;
a NULL site is one site of its own; a row with a NULL key is no line's first
carrier unless no row with the line has a key; repeated rows change alike; an empty
table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import checkpointed, key_text

MIN_SITES = 5
LOG_REGISTERS = 10
#: Boilerplate lines up to which their keys are broadcast; beyond it both sides are shuffled.
BROADCAST_LINES = 200_000
#: Standard errors of a sketch, 1.04 / sqrt(registers) each, on either side of the threshold within which lines are counted.
ERRORS = 6

_LINES = "split(coalesce({t}, ''), '\\n', -1)"
_KEY = "unhex(md5(trim(BOTH ' \\t\\r' FROM {x})))"
_HAS_TEXT = "length(trim(BOTH ' \\t\\r' FROM {x})) > 0"


def _occurrences(docs: DataFrame, key: str, site: str, text: str, *more: Column) -> DataFrame:
    """A row for each line with text: _doc, _site, what ``more`` adds, _at (place from 0), _line."""
    keys = f"transform({_LINES.format(t='_text')}, x -> if({_HAS_TEXT.format(x='x')}, {_KEY.format(x='x')}, null))"
    head = docs.select(F.col(key).alias("_doc"), key_text(F.col(site)).alias("_site"), *more, F.col(text).alias("_text"))
    # The outer form: for the inner one Catalyst adds a filter that works out the array again.
    return head.select(*[c for c in head.columns if c != "_text"], F.posexplode_outer(F.expr(keys)).alias("_at", "_line")).where("_line is not null")


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", site: str = "source", text: str = "text", log_registers: int = LOG_REGISTERS) -> DataFrame:
    """Lines on ``min_sites`` sites or more: (_line, _first, sites as estimated or counted), staged.

    One pass merges a sketch of sites, the first document and a row count for each line;
    partial aggregation keeps a line on one source from meeting in one task. Lines whose
    estimate lies within the margin are counted exactly by a second scan that keeps no
    other line.
    """
    spread = estimated_sites(docs, min_sites, key, site, text, log_registers)
    near = _small(spread.where("near").select("_line"))
    again = _occurrences(docs, key, site, text).select("_line", "_site").join(near, "_line", "left_semi").distinct()
    exact = again.groupBy("_line").agg(F.count("*").alias("counted"))
    counted = spread.join(exact, "_line", "left").withColumn("sites", F.coalesce("counted", "sites"))
    return checkpointed(counted.where(F.col("sites") >= min_sites).select("_line", "_first", "sites"))


def estimated_sites(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", site: str = "source", text: str = "text", log_registers: int = LOG_REGISTERS) -> DataFrame:
    """Lines whose sketch does not rule out ``min_sites`` sites: (_line, _first, sites as estimated, near), staged."""
    margin = max(1.0, ERRORS * 1.04 / 2 ** (log_registers / 2) * min_sites)
    spread = (
        _occurrences(docs, key, site, text)
        .groupBy("_line")
        .agg(F.hll_sketch_agg("_site", F.lit(log_registers)).alias("sketch"), F.min("_doc").alias("_first"), F.count("*").alias("n"))
        # A line with fewer rows than sites wanted is told apart by its rows.
        .where(F.col("n") >= min_sites)
        .select("_line", "_first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites - margin)
    )
    return checkpointed(spread.withColumn("near", F.col("sites") <= min_sites + margin))


def _small(lines: DataFrame) -> DataFrame:
    """``lines`` with a broadcast hint where a count shows that they are few; staged tables only."""
    return F.broadcast(lines) if lines.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES else lines


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", site: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with boilerplate lines gone from the text column, and two counts.

    What goes is sent to the texts as sorted places, one row for each key and text, so rows
    of one key do not meet in one task and a text of any number of lines costs time in
    proportion. Columns: ``row`` (the input row, text replaced), ``n_lines`` (0 for a
    NULL text) and ``n_removed``.
    """
    # It is staged, so that the join below has a shuffle of its own on both sides, which can be split where skewed.
    bad = _small(boilerplate(docs, min_sites, key, site, text))
    digest = F.md5(F.col(text).cast("binary"))
    losing = (
        _occurrences(docs, key, site, text, digest.alias("_digest"))
        .join(bad, "_line")
        .where(~F.col("_doc").eqNullSafe(F.col("_first")))
        .groupBy("_doc", "_digest")
        .agg(F.sort_array(F.collect_set("_at")).alias("_gone"))
    )
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), digest.alias("_key"))
    joined = rows.join(losing, F.col(f"row.`{key}`").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_digest")), "left")
    body = f"row.`{text}`"
    lines = _LINES.format(t=body)
    # Runs of lines between places that go; slices of one array, so the whole is linear.
    kept = "flatten(zip_with(concat(array(-1), _gone), concat(_gone, array(size(_split))), (a, b) -> slice(_split, a + 2, b - a - 1)))"
    return (
        joined.withColumn("_split", F.expr(f"if({body} is null, null, {lines})"))
        .withColumn("_kept", F.expr(f"if(_gone is null, null, {kept})"))
        .withColumn("n_lines", F.expr(f"if({body} is null, 0, size(_split))").cast("long"))
        .withColumn("n_removed", F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long"))
        .select(
            F.struct(
                *[(F.when(F.col("_kept").isNull(), F.col(body)).otherwise(F.array_join("_kept", "\n")) if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
            ).alias("row"),
            "n_lines",
            "n_removed",
        )
    )


def cleaned_documents(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", site: str = "source", text: str = "text") -> DataFrame:
    """``docs`` without boilerplate; documents that lose their last words go."""
    out = remove_boilerplate(docs, min_sites, key, site, text)
    return out.where((F.col("n_removed") == 0) | F.col(f"row.`{text}`").rlike(r"\S")).select("row.*")


ORACLE = f"""
WITH line AS (
  SELECT doc_id, source, u.pos, u.x AS line, trim(u.x, ' ' || chr(9) || chr(13)) AS body
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS xs FROM documents WHERE text IS NOT NULL), unnest(xs) WITH ORDINALITY AS u(x, pos)
), bad AS (
  SELECT body, min(doc_id) AS first FROM line WHERE length(body) > 0 GROUP BY body HAVING count(DISTINCT coalesce(source, chr(92) || 'N')) >= {MIN_SITES}
), kept AS (
  SELECT doc_id, pos, line, (bad.body IS NOT NULL AND line.doc_id <> bad.first) AS gone FROM line LEFT JOIN bad ON line.body = bad.body
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed, c.text
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
"""
