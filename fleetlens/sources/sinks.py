"""Writers and readers of results: Parquet tables, JSON records, CSV, HTML pages."""

from __future__ import annotations

import html
import json
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JSON_OPTIONS = {"ignoreNullFields": "false"}


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json_records(df: DataFrame, path: str) -> None:
    """One JSON object a line, NULL fields written; many files, written by executors."""
    df.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value")).write.mode("overwrite").text(path)


def read_json_records(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def payload(header: dict, records: DataFrame, key: str = "vehicles") -> str:
    """The compact single-document form, for results small enough for one page."""
    rows = [json.loads(r.value) for r in records.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value")).toLocalIterator()]
    return json.dumps({**header, key: rows}, separators=(",", ":"), default=str)


def read_payload(spark: SparkSession, path: str, key: str = "vehicles") -> DataFrame:
    """Records of a single-document file."""
    return spark.read.option("multiLine", True).json(path).select(F.explode(key).alias("r")).select("r.*")


def write_csv(df: DataFrame, path: str) -> None:
    """A small reference table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_fleet_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path).withColumn("variant", F.trim("variant"))


def write_page(spark: SparkSession, text: str, path: str) -> None:
    """One page as a text file, in whatever store the path is."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def lookup(records: DataFrame, imei: str, variant: str | None = None) -> DataFrame:
    """The record of one vehicle; the filter reaches a Parquet scan. Without a variant, the first one that has the id."""
    found = records.where(F.col("imei") == imei)
    return found.where(F.col("variant") == variant) if variant else found.orderBy("variant").limit(1) if "variant" in records.columns else found.limit(1)


def find_record(spark: SparkSession, path: str, schema, imei: str, variant: str | None = None) -> dict | None:
    """Best effort: one vehicle's record of a JSON records folder; None where folder or vehicle is missing.

    Damaged lines become NULL fields under the schema and so match no vehicle.
    """
    try:
        found = lookup(read_json_records(spark, path, schema), imei, variant).first()
    except AnalysisException:
        return None
    return found.asDict(recursive=True) if found else None


def render(template: str, document: str) -> str:
    """A template with its data put in; closing tags in the data cannot end the script."""
    return template.replace("{{DATA_JSON}}", document.replace("</", "<\\/"))


DASHBOARD = """<!DOCTYPE html><meta charset="utf-8"><title>Fleet verdicts</title><table id="t"></table>
<script>const D={{DATA_JSON}};
document.getElementById('t').innerHTML=D.vehicles.map(v=>`<tr><td>${v.imei}</td><td>${v.variant}</td><td>${v.verdict}</td><td>${v.watch_reason}</td></tr>`).join('');
</script>"""


def cell(value) -> str:
    if value is None:
        return "&mdash;"
    return f"{value:.2f}" if isinstance(value, float) else html.escape(str(value))


def html_rows(title: str, rows: list[dict]) -> str:
    """Rows of one section as a table."""
    head = "".join(f"<th>{html.escape(c)}</th>" for c in (rows[0] if rows else ()))
    body = "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in row.values()) + "</tr>" for row in rows)
    return f"<h2>{html.escape(title)}</h2><table><tr>{head}</tr>{body}</table>"


def page_path(variant: str, imei: str) -> str:
    """Where the page of a vehicle lies beside the index, as partition folders name it."""
    return f"pages/variant={quote(variant, safe=' |')}/imei={quote(imei, safe=' |')}/"


def index_page(index: DataFrame) -> str:
    """A table of reports: a link and the facts of each vehicle, or why it has none. One short row a vehicle."""
    facts = [c for c in index.columns if c not in ("variant", "imei", "error")]
    rows = []
    for r in index.toLocalIterator():
        shown = f"{html.escape(r.imei)} ({html.escape(r.variant)})"
        rest = f'<td colspan="{len(facts)}">failed: {html.escape(r.error)}</td>' if r.error else "".join(f"<td>{cell(r[c])}</td>" for c in facts)
        link = shown if r.error else f'<a href="../{html.escape(page_path(r.variant, r.imei))}">{shown}</a>'
        rows.append(f"<tr><td>{link}</td>{rest}</tr>")
    head = "".join(f"<th>{c}</th>" for c in ("vehicle", *facts))
    return page("Reports", [f"<table><tr>{head}</tr>{''.join(rows)}</table>"])


def page(title: str, parts: list[str]) -> str:
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{"".join(parts)}</body></html>'
