"""Variant thresholds and the eight contradiction detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import CHARGE, DEFAULT, DETECTORS, RUN, Settings
from fleetlens.functions.core import VEHICLE
from fleetlens.functions.quantiles import Wanted, exact_percentiles
from fleetlens.functions.shared import small, staged
from fleetlens.operators.sessions import charge_sessions_of, dwell_runs, trips_of

# Threshold names and mask conditions of the results.
THRESHOLDS = (
    *[f"{s}_p{p}" for s in ("rpm", "torque", "current", "throttle") for p in (25, 50, 75, 90)],
    "speed_p25",
    "temp_p90",
    "ratio_rpm_speed_p95",
    "charge_current_p75",
)

# Mask conditions.
#: True where the contradiction holds; NULL inputs and thresholds never hold.
RUN_MASKS = {
    "d1_rpm_speed": "speed > 3 and rpm > 50 and rpm / nullif(speed, 0) > ratio_rpm_speed_p95",
    "d2_throttle_speed": "throttle >= throttle_p75 and speed <= speed_p25",
    "d3_throttle_current": "throttle >= throttle_p75 and current <= current_p25",
    "d4_current_torque": "current >= current_p75 and torque <= torque_p25",
    "d5_current_rpm_torque": "current >= current_p75 and rpm >= rpm_p75 and torque <= torque_p50",
    "d6_torque_speed": "torque >= torque_p90 and speed <= speed_p25",
    "d8_temp_overheat": "temp >= temp_p90 and current <= current_p25",
}
CHARGE_MASK = "soc >= 95 and current >= charge_current_p75"


def variant_thresholds(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Exact percentiles of each variant, over driving rows or, where these are too few, all its rows; NULL without data.

    Row counts by state come first: they tell which rows of a variant count. The
    percentiles are bracketed by sketches, so no values but those next to a threshold are
    shuffled, and no task holds a variant. A variant is one row of every joined table.
    """
    gate = staged(rows.groupBy("variant").agg(F.count_if(F.col("state") == RUN).alias("runs"), F.count_if(F.col("state") == CHARGE).alias("charges")))
    counts = (F.col("state") == RUN) | (F.col("runs") < settings.min_drive_rows)
    of = lambda c: F.when(counts, F.col(c))
    four = ("rpm", "torque", "current", "throttle")
    found = exact_percentiles(
        rows.select("variant", "state", *four, "speed", "temp").join(small(gate), "variant"),
        ["variant"],
        [
            *[Wanted(s, of(s), (0.25, 0.5, 0.75, 0.9)) for s in four],
            Wanted("speed", of("speed"), (0.25,)),
            Wanted("temp", of("temp"), (0.9,)),
            Wanted("ratio", F.when(counts & (F.col("speed") > 3) & (F.col("rpm") > 50), F.col("rpm") / F.col("speed")), (0.95,)),
            Wanted("charge", F.when(F.col("state") == CHARGE, F.col("current")), (0.75,)),
        ],
    )
    return gate.join(found, "variant", "left").select(
        "variant",
        *[F.col(s)[i].alias(f"{s}_p{p}") for s in four for i, p in enumerate((25, 50, 75, 90))],
        F.col("speed")[0].alias("speed_p25"),
        F.col("temp")[0].alias("temp_p90"),
        F.col("ratio")[0].alias("ratio_rpm_speed_p95"),
        F.when(F.col("charges") >= settings.min_charge_rows, F.col("charge")[0]).alias("charge_current_p75"),
    )


def _unpivot(rows: DataFrame, unit: list[str], masks: dict[str, str]) -> DataFrame:
    at = [*unit, "slice", "slice_first", "slice_last", "place"]
    hits = F.explode(F.array(*[F.struct(F.lit(d).alias("det"), F.coalesce(F.expr(m), F.lit(False)).alias("hit")) for d, m in masks.items()])).alias("d")
    return rows.select(*at, hits).select(*at, "d.det", "d.hit")


def trip_events(rows: DataFrame, thresholds: DataFrame, settings: Settings = DEFAULT, only: list[str] | None = None) -> DataFrame:
    """Events of the driving detectors: one row for each trip and detector that fired.

    ``rows`` are as ``trips_of`` gives them. Thresholds are staged and one row a variant: where
    they are few they are broadcast, since a shuffle would put a variant into one task. All
    detectors share one pass.
    """
    masks = {d: m for d, m in RUN_MASKS.items() if only is None or d in only}
    joined = rows.join(small(thresholds), "variant", "left")
    return dwell_runs(_unpivot(joined, [*VEHICLE, "trip_id"], masks), [*VEHICLE, "trip_id"], settings.dwell, settings.row_seconds)


def charge_events(sessions: DataFrame, thresholds: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Events of the charging detector for each charge session."""
    joined = sessions.join(small(thresholds, thresholds.select("variant", "charge_current_p75")), "variant", "left")
    return dwell_runs(_unpivot(joined, [*VEHICLE, "session_id"], {"d7_charge_overtaper": CHARGE_MASK}), [*VEHICLE, "session_id"], settings.dwell, settings.row_seconds)


def events_of(rows: DataFrame, det: str, settings: Settings = DEFAULT) -> DataFrame:
    """Events of one detector straight from telemetry."""
    thresholds = staged(variant_thresholds(rows, settings))
    if det == "d7_charge_overtaper":
        return charge_events(charge_sessions_of(rows, settings), thresholds, settings)
    return trip_events(trips_of(rows, settings), thresholds, settings, [det])


RUN_DETECTORS = tuple(d for d in DETECTORS if d in RUN_MASKS)
