"""Streaming trips and dwell counts: an extension with no batch-only counterpart.

Sessions close once the watermark passes the gap; rows later than the watermark are
dropped, as Structured Streaming defines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, Settings
from fleetlens.functions.core import VEHICLE
from fleetlens.operators.sessions import moving


def streaming_trips(rows: DataFrame, settings: Settings = DEFAULT, late: str = "15 minutes") -> DataFrame:
    """Trips of a stream of clean telemetry: one row a session once it is complete.

    The same strict gap rule as in batch: a gap of exactly the limit stays inside.
    """
    gap = f"{int(settings.trip_gap * settings.unit_s)} seconds"
    return (
        moving(rows)
        .withWatermark("time", late)
        .groupBy(*VEHICLE, F.session_window("time", gap).alias("w"))
        .agg(F.count("*").alias("n_rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.avg("speed").alias("mean_speed"), (F.max("odometer") - F.min("odometer")).alias("dist_km"))
        .drop("w")
    )


def hot_minutes(rows: DataFrame, late: str = "15 minutes") -> DataFrame:
    """Readings above 50 degrees for each variant and minute."""
    return rows.withWatermark("time", late).groupBy("variant", F.window("time", "1 minute").alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("temp") > 50).alias("hot")).select("variant", F.col("w.start").alias("minute"), "n", "hot")
