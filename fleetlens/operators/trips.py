"""Trip table, charge summary and vehicle profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, DETECTORS, MATCH_FEATURES, Settings
from fleetlens.functions.core import VEHICLE, micros, ratio
from fleetlens.operators.detectors import RUN_DETECTORS, charge_events, trip_events
from fleetlens.operators.sessions import charge_sessions_of, trips_of

# Metrics of a trip, in the order of the results.
METRICS = (
    "duration_min", "dist_km", "mean_speed", "avg_speed", "p90_speed", "median_rpm", "p90_rpm", "median_torque", "p90_torque", "median_throttle", "p90_throttle",
    "low_speed_frac", "median_current", "p90_current", "median_temp", "soc_start", "soc_end", "soc_consumed", "km_per_soc_pct", "peak_temp", "temp_delta_c",
    "current_per_speed", "current_per_torque", "current_spike_rate", "high_temp_rate", "mode_0_frac", "mode_1_frac",
)
KEY = [*VEHICLE, "trip_id"]


def _first(c: str):
    return F.expr(f"min_by({c}, struct(time, seq)) filter (where {c} is not null)")


def _last(c: str):
    return F.expr(f"max_by({c}, struct(time, seq)) filter (where {c} is not null)")


def active_minutes(settings: Settings):
    """Aggregate: sum of short gaps inside a trip, in minutes, to 4 places half-even."""
    inner = F.col("trip_gap_units") <= settings.max_sample_gap
    return F.bround(F.coalesce(F.sum(F.when(inner, F.col("trip_gap_units"))), F.lit(0.0)) / settings.units_per_minute, 4)


def raw_trip_metrics(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row a trip with all metrics and what the gates need. ``rows`` carry ``trip_id``.

    Rows lie by vehicle and slice of time, so the partial aggregate leaves a row or two of
    most trips to be shuffled.
    """
    p = lambda c: F.percentile(c, F.array(F.lit(0.5), F.lit(0.9)))
    # The gap before a trip's first row is over the limit or NULL, so it never counts.
    agg = rows.withColumn("trip_gap_units", F.col("gap")).groupBy(*KEY).agg(
        F.count("*").alias("n_rows"),
        active_minutes(settings).alias("duration_min"),
        F.count("odometer").alias("n_odo"),
        (_last("odometer") - _first("odometer")).alias("dist_km"),
        F.avg("speed").alias("mean_speed"),
        *[p(c).alias(f"p_{c}") for c in ("speed", "rpm", "torque", "throttle", "current", "temp")],
        (F.count_if(F.col("speed") < 10) / F.count("*")).alias("low_speed_frac"),
        (F.count_if(F.col("current") > 150) / F.count("*")).alias("current_spike_rate"),
        (F.count_if(F.col("temp") > 50) / F.count("*")).alias("high_temp_rate"),
        _first("soc").alias("soc_start"),
        _last("soc").alias("soc_end"),
        F.max("temp").alias("peak_temp"),
        F.when(F.count("temp") >= 2, F.max("temp") - F.min("temp")).alias("temp_delta_c"),
        F.count_if(F.col("mode") == 0).alias("m0"),
        F.count_if(F.col("mode") == 1).alias("m1"),
    )
    out = agg.withColumn("avg_speed", F.col("mean_speed")).withColumn("soc_consumed", F.col("soc_start") - F.col("soc_end"))
    for c in ("rpm", "torque", "throttle", "current", "temp"):
        out = out.withColumn(f"median_{c}", F.col(f"p_{c}")[0])
    for c in ("speed", "rpm", "torque", "throttle", "current"):
        out = out.withColumn(f"p90_{c}", F.col(f"p_{c}")[1])
    # Both shares are quotients: one less the other is off by a last bit, which bands at a limit show.
    share = lambda n: F.coalesce(F.try_divide(F.col(n).cast("double"), F.col("m0") + F.col("m1")), F.lit(0.0))
    return (
        out.withColumn("km_per_soc_pct", ratio(F.col("dist_km"), F.col("soc_consumed")))
        .withColumn("current_per_speed", ratio(F.col("median_current"), F.col("mean_speed")))
        .withColumn("current_per_torque", ratio(F.col("median_current"), F.col("median_torque")))
        .withColumn("mode_0_frac", share("m0"))
        .withColumn("mode_1_frac", share("m1"))
        .select(*KEY, "n_rows", "n_odo", *METRICS)
    )


def gate(settings: Settings = DEFAULT):
    """The condition that keeps a trip."""
    return (
        (F.col("n_rows") >= 2)
        & (F.col("duration_min") >= settings.min_minutes)
        & (F.col("n_odo") >= 2)
        & (F.col("dist_km") >= settings.min_km)
        & F.coalesce(F.col("km_per_soc_pct") <= settings.max_km_per_soc, F.lit(True))
    )


def trip_table(rows: DataFrame, thresholds: DataFrame, settings: Settings = DEFAULT, whole: bool = False) -> DataFrame:
    """Valid trips: metrics, and events and longest dwell of every detector (0 where none); ``whole`` as in ``trips_of``."""
    moving_rows = trips_of(rows, settings, whole)
    kept = raw_trip_metrics(moving_rows, settings).where(gate(settings)).drop("n_rows", "n_odo")
    wide = (
        trip_events(moving_rows, thresholds, settings)
        .groupBy(*KEY)
        .pivot("det", list(RUN_DETECTORS))
        .agg(F.first("events").alias("events"), F.first("max_dwell_s").alias("max_dwell_s"))
    )
    return kept.join(wide, KEY, "left").select(
        *KEY,
        *METRICS,
        *[(F.coalesce(F.col(f"{d}_events"), F.lit(0)) if d in RUN_DETECTORS else F.lit(0)).cast("long").alias(f"{d}_events") for d in DETECTORS],
        *[(F.coalesce(F.col(f"{d}_max_dwell_s"), F.lit(0.0)) if d in RUN_DETECTORS else F.lit(0.0)).alias(f"{d}_max_dwell_s") for d in DETECTORS],
    )


def charge_summary(rows: DataFrame, thresholds: DataFrame, settings: Settings = DEFAULT, whole: bool = False) -> DataFrame:
    """One row a vehicle: hours, events and longest dwell over sessions of enough rows; zeros without any. ``whole`` as in ``trips_of``."""
    sessions = charge_sessions_of(rows, settings, whole)
    key = [*VEHICLE, "session_id"]
    spans = (
        sessions.groupBy(*key)
        .agg(F.count("*").alias("n"), ((F.max(micros("time")) - F.min(micros("time"))) / F.lit(1e6 * settings.unit_s)).alias("span"))
        .where(F.col("n") >= settings.min_session_rows)
    )
    found = (
        spans.join(charge_events(sessions, thresholds, settings), key, "left")
        .groupBy(*VEHICLE)
        .agg((F.sum("span") / F.lit(settings.units_per_minute * 60)).alias("charge_hours"), F.sum(F.coalesce("events", F.lit(0))).alias("d7_events"), F.max("max_dwell_s").alias("d7_max_dwell_s"))
    )
    zero = lambda c, z: F.coalesce(F.col(c), F.lit(z)).alias(c)
    return rows.select(*VEHICLE).distinct().join(found, list(VEHICLE), "left").select(*VEHICLE, zero("d7_events", 0), zero("d7_max_dwell_s", 0.0), zero("charge_hours", 0.0))


def profiles(trips: DataFrame, charges: DataFrame) -> DataFrame:
    """One row for each vehicle with a valid trip: medians of the match features and detector rates."""
    run = [d for d in DETECTORS if d in RUN_DETECTORS]
    base = trips.groupBy(*VEHICLE).agg(
        F.count("*").alias("n_trips"),
        *[F.median(c).alias(c) for c in MATCH_FEATURES],
        (F.sum("duration_min") / 60).alias("drive_hours"),
        *[F.sum(f"{d}_events").alias(f"{d}_events_total") for d in run],
        *[F.max(f"{d}_max_dwell_s").alias(f"{d}_max_dwell_s") for d in run],
    )
    joined = base.join(charges, list(VEHICLE), "left").na.fill({"d7_events": 0, "d7_max_dwell_s": 0.0, "charge_hours": 0.0})
    rate = lambda n, h: F.when(F.col(h) > 0, F.col(n) / F.col(h)).otherwise(0.0)
    joined = joined.withColumns({"d7_charge_overtaper_events_total": F.col("d7_events"), "d7_charge_overtaper_max_dwell_s": F.col("d7_max_dwell_s")})
    return joined.select(
        *VEHICLE,
        "n_trips",
        *MATCH_FEATURES,
        "drive_hours",
        "charge_hours",
        *[rate(f"{d}_events_total", "charge_hours" if d.startswith("d7") else "drive_hours").alias(f"{d}_rate") for d in DETECTORS],
        *[f"{d}_events_total" for d in DETECTORS],
        *[f"{d}_max_dwell_s" for d in DETECTORS],
    )
