"""Plain-language account of a verdict, as an array of sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, DETECTORS, Settings

REASONS = {
    "ML_ONLY_PATTERN": "its usage pattern is unusual, but no signal pair contradicts itself",
    "ML_PLUS_ONE_DUAL": "its usage pattern is unusual and one signal pair contradicts itself",
    "PHYSICS_ONLY_NO_ML": "signal pairs contradict themselves although its usage pattern is ordinary",
    "INSUFFICIENT_PEERS": "there are too few comparable vehicles to judge its signals",
    "PARTIAL_EVIDENCE": "the evidence is partial",
}


def strength(z: Column) -> Column:
    a = F.abs(z)
    return F.when(a >= 4, "far beyond its peers").when(a >= 3, "well beyond its peers").when(a >= 2, "clearly beyond its peers").otherwise("above its peers")


def _fixed(x: Column, places: int) -> Column:
    """Half-even decimals as text; Java's own formatting rounds halves up."""
    return F.format_string(f"%.{places}f", F.bround(x, places))


def _detector(d: str) -> Column:
    z, rate = F.col(f"{d}_z"), F.col(f"{d}_rate")
    facts = F.array_compact(
        F.array(
            F.when(F.col(f"{d}_events_total") > 0, F.format_string("%d event(s)", F.col(f"{d}_events_total").cast("long"))),
            F.when(F.col(f"{d}_max_dwell_s") > 0, F.concat(F.lit("longest "), _fixed(F.col(f"{d}_max_dwell_s"), 0), F.lit(" s"))),
            F.when(z.isNotNull(), F.concat(strength(z), F.lit(" (z "), _fixed(z, 1), F.lit(")"))).when(rate > 0, F.concat(_fixed(rate, 2), F.lit(" per hour"))),
        )
    )
    return F.when(F.array_contains("strong_metric_ids", f"{d}_rate"), F.concat(F.lit(f"{DETECTORS[d]}: "), F.array_join(facts, ", "), F.lit(".")))


def explanations(records: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Adds ``explanations``: headline, one sentence a strong detector, notes and caveats."""
    why = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    v, n = F.col("verdict"), F.col("strong_metric_count").cast("long")
    headline = (
        F.when(v == "ELEVATED", F.format_string("Elevated: an unusual usage pattern together with %d strong signal contradictions.", n))
        .when(v == "WATCH", F.concat(F.lit("Watch: "), F.coalesce(why[F.col("watch_reason")], F.lit(REASONS["PARTIAL_EVIDENCE"])), F.lit(".")))
        .when((v == "NORMAL") & F.col("spirited"), F.format_string("Normal: driven fast, with %d strong contradiction(s), too few to count against it.", n))
        .when(v == "NORMAL", F.lit("Normal: it behaves like the vehicles it is compared with."))
        .otherwise(F.concat(F.lit("Verdict "), F.coalesce(v, F.lit("unknown")), F.lit(".")))
    )
    notes = [
        F.when(F.col("spirited") & (v == "ELEVATED"), F.lit("It is also driven fast; repeated contradictions outweigh driving style.")),
        F.when((F.col("n_peers") > 0) & (F.col("n_peers") < settings.min_peers) & (v != "NORMAL"), F.format_string("Caution: only %d comparable vehicles.", F.col("n_peers").cast("long"))),
        F.when((F.col("n_trips") <= 2) & v.isin("ELEVATED", "WATCH"), F.format_string("Caution: based on %d trip(s).", F.col("n_trips").cast("long"))),
    ]
    return records.withColumn("explanations", F.array_compact(F.array(headline, *map(_detector, DETECTORS), *notes)))
