"""Seeded synthetic telemetry in the raw schema, made by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build(spark: SparkSession, vehicles: int = 30, seed: int = 42, faulty_every: int = 7) -> DataFrame:
    """Raw telemetry: 3 to 6 trips a vehicle, 150 to 319 rows a trip at 5 s, a charge session after each.

    Every ``faulty_every``-th vehicle slips on its even trips: high engine speed and
    throttle while it hardly moves. Randomness is a hash of (seed, row), so the
    table does not depend on partitioning.
    """
    u = lambda *k: F.pmod(F.xxhash64(F.lit(seed), *k), F.lit(1_000_003)) / 1_000_003.0
    base = spark.range(vehicles).select(F.col("id").alias("v"))
    trips = base.select("v", F.explode(F.sequence(F.lit(0), (F.lit(2) + F.floor(u(F.lit("n"), "v") * 4)).cast("int"))).alias("t"))
    rows = trips.select("v", "t", F.explode(F.sequence(F.lit(0), (F.lit(149) + F.floor(u(F.lit("r"), "v", "t") * 170)).cast("int"))).alias("i"))
    fault = (F.col("v") % faulty_every == 0) & (F.col("t") % 2 == 0)
    noise = lambda name: u(F.lit(name), "v", "t", "i") - 0.5
    slip = fault & (F.col("i") % 40 < 12)
    speed = F.when(slip, 4 + noise("s") * 1.5).otherwise(24 + 10 * F.sin(F.col("i") / 15) + noise("s") * 6)
    drive = rows.select(
        F.format_string("86%013d", F.col("v")).alias("imei"),
        (F.lit(1_700_000_000) + F.col("t") * 14_400 + F.col("i") * 5 + F.col("v")).alias("at"),
        (F.col("v") * 10 + F.col("t") * 9 + F.col("i") * 0.033).alias("odometer"),
        F.when(slip, 5200 + noise("p") * 300).otherwise(speed * 70 + noise("p") * 200).alias("rpm"),
        F.when(slip, 25 + noise("q") * 10).otherwise(50 + noise("q") * 40).alias("torque"),
        speed.alias("speed"),
        F.when(slip, 8.5 + noise("h")).otherwise(4 + noise("h") * 3).alias("throttle"),
        F.when(slip, 170 + noise("c") * 20).otherwise(80 + noise("c") * 50).alias("current"),
        (38 + noise("m") * 10 + F.when(slip, 12).otherwise(0)).alias("controllerTemperature"),
        (95 - F.col("t") * 3 - F.col("i") * 0.03).alias("soc"),
        F.lit(2).alias("vehicleState"),
        F.when(noise("e") > 0.1, 1).otherwise(0).alias("controllerControllerMode"),
        F.when(F.col("v") % 2 == 0, "City").otherwise("Cargo").alias("vehicle_variant_name"),
    )
    charge = trips.select("v", "t", F.explode(F.sequence(F.lit(0), F.lit(59))).alias("i")).select(
        F.format_string("86%013d", F.col("v")).alias("imei"),
        (F.lit(1_700_000_000) + F.col("t") * 14_400 + 7200 + F.col("i") * 30 + F.col("v")).alias("at"),
        *[F.lit(None).cast("double").alias(c) for c in ("odometer", "rpm", "torque")],
        F.lit(0.0).alias("speed"),
        F.lit(0.0).alias("throttle"),
        (40 - F.col("i") * 0.5 + F.when(fault & (F.col("i") > 50), 40).otherwise(0)).alias("current"),
        (30 + noise("m") * 4).alias("controllerTemperature"),
        (70 + F.col("i") * 0.5).alias("soc"),
        F.lit(1).alias("vehicleState"),
        F.lit(0).alias("controllerControllerMode"),
        F.when(F.col("v") % 2 == 0, "City").otherwise("Cargo").alias("vehicle_variant_name"),
    )
    whole = drive.unionByName(charge).withColumn("vehicle_model_name", F.lit("Demo")).withColumn("time", F.date_format(F.timestamp_seconds("at"), "yyyy-MM-dd HH:mm:ss"))
    return whole.drop("at").select(*[F.col(c).cast("string").alias(c) for c in whole.columns if c != "at"])
