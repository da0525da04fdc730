"""The two older forms of the verdict document, for readers of such files.

``piped`` joins the names of strong detectors by bars, adds explanations and counts the
vehicles without valid trips; ``listed`` joins them by semicolons, adds a severity, and
counts the reasons of WATCH alone. Both are derived from verdict records with a column
``trips``; other columns stay.

Defined results: records without strong detectors have an empty text; a text that is
already there stays in ``piped``, and in ``listed`` unless it is empty; of no records all
counts are 0 and all maps are empty.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, DETECTORS, Settings
from fleetlens.functions.core import verdict_severity
from fleetlens.operators import explain, peers

# What joins the names of strong detectors in each form.
JOINS = {"piped": " | ", "listed": "; "}
#: Stands for the reasons of other verdicts while those of WATCH are counted.
_OTHER = "\0"


def records(judged: DataFrame, form: str, settings: Settings = DEFAULT) -> DataFrame:
    """Verdict records in the older ``form``."""
    label = F.create_map(*[F.lit(x) for d, t in DETECTORS.items() for x in (f"{d}_rate", t)])
    made = F.array_join(F.transform(F.coalesce("strong_metric_ids", F.array().cast("array<string>")), lambda i: F.coalesce(label[i], i)), JOINS[form])
    if "strong_metrics" in judged.columns:
        made = F.coalesce("strong_metrics" if form == "piped" else F.nullif(F.col("strong_metrics"), F.lit("")), made)
    out = judged.withColumn("strong_metrics", made)
    if form == "listed":
        return out.withColumn("severity", verdict_severity(F.col("verdict")))
    missing = {c: v for c, v in {"review_recommendation": F.lit(""), "timeline": F.lit(None).cast("string")}.items() if c not in judged.columns}
    return explain.explanations(out.withColumns(missing), settings)


def summary(judged: DataFrame, form: str, settings: Settings = DEFAULT) -> DataFrame:
    """The summary of the older ``form``: counts and maps of counts in one row."""
    if form == "listed":
        judged = judged.withColumn("watch_reason", F.when(F.col("verdict") == "WATCH", F.col("watch_reason")).otherwise(F.lit(_OTHER)))
    out = peers.summary_record(judged, settings)
    total = F.col("total_validated")
    out = out.withColumns({"dashboard_vehicles": total, "dashboard_joined_to_validator": total, "high": F.lit(0).cast("long")})
    if form == "piped":
        return out.withColumn("pipeline_version", F.concat("pipeline_version", F.lit("-via-adapter")))
    return out.withColumns(
        {
            "watch_reason_counts": F.map_filter("watch_reason_counts", lambda k, _: k != _OTHER),
            "vehicles_with_valid_trips": total,
            "no_valid_trips": F.lit(0).cast("long"),
        }
    )


def head(judged: DataFrame, form: str, settings: Settings = DEFAULT) -> dict:
    """What stands before the records in a document: the summary with the parameters. Its maps have a row a verdict, reason or variant."""
    return {"summary": {**summary(judged, form, settings).first().asDict(recursive=True), "params": asdict(settings)}}
