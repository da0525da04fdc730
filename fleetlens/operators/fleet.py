"""Fleet reference buckets and comparisons with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import DANGER_DETECTORS, DEFAULT, Settings
from fleetlens.functions.core import VEHICLE, detector_status, deviation, deviation_band, half_even_bin, mode_class, uneven_bin
from fleetlens.functions.quantiles import exact_medians
from fleetlens.functions.shared import small, staged
from fleetlens.operators.detectors import RUN_DETECTORS

# Reported attributes, bucket edges and map edges.
ATTRIBUTES = ("mean_speed", "p90_speed", "median_rpm", "p90_rpm", "median_torque", "p90_torque", "median_throttle", "p90_throttle", "low_speed_frac", "median_current", "p90_current", "median_temp", "peak_temp", "mode_0_frac", "mode_1_frac")
EVENT_ATTRIBUTES = tuple(f"{d}_events" for d in RUN_DETECTORS)
SHOWN = ("mean_speed", "median_rpm", "median_torque", "median_throttle", "median_current", "median_temp", "mode_0_frac", "mode_1_frac")
#: Edges of the time-in-bucket shares; the last bucket is open.
SHARE_EDGES = {"current": [0, 50, 100, 150, 200], "temp": [0, 25, 40, 55, 70], "rpm": [0, 1500, 3000, 4500, 6000], "torque": [0, 25, 50, 75, 100], "throttle": [0, 2, 4, 6, 8], "speed": [0, 15, 30, 45, 60]}
MAP_EDGES = {"current": [0, 50, 100, 150, 200, 250, 300], "rpm": [0, 1000, 2000, 3000, 4000, 5000, 6000, 7000], "torque": [0, 25, 50, 75, 100, 125, 150], "throttle": [0, 2, 4, 6, 8, 10], "speed": [0, 10, 20, 30, 40, 50, 60, 80], "temp": [0, 20, 30, 40, 50, 60, 80]}
MAP_PAIRS = (("current", "rpm"), ("current", "torque"), ("current", "throttle"), ("current", "speed"), ("current", "temp"), ("rpm", "torque"), ("rpm", "speed"), ("torque", "speed"), ("throttle", "speed"), ("temp", "speed"))
TRIP = [*VEHICLE, "trip_id"]


def with_bins(trips: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return trips.withColumns({"duration_bin": half_even_bin(F.col("duration_min"), settings.minutes_bin), "soc_consumed_bin": half_even_bin(F.col("soc_consumed"), settings.soc_bin)})


def reference(trips: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Medians of each (variant, duration bin, charge bin) with enough trips, in order.

    Trips of buckets that are too small go before the medians; a bucket may hold a third of all trips.
    """
    key, attributes = ["variant", "duration_bin", "soc_consumed_bin"], [*ATTRIBUTES, *EVENT_ATTRIBUTES]
    binned = with_bins(trips, settings).where("duration_bin is not null and soc_consumed_bin is not null").select(*key, *attributes)
    sizes = staged(binned.groupBy(*key).agg(F.count("*").alias("fleet_n")).where(F.col("fleet_n") >= settings.min_bucket))
    medians = exact_medians(binned.join(small(sizes), key), key, attributes, "median_")
    return sizes.join(medians, key).withColumn("low_confidence", F.col("fleet_n") < settings.low_confidence).orderBy(*key)


def nearest_bucket(trips: DataFrame, fleet: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Trips with their bucket's columns: the same bins, else the nearest of the variant.

    Trips are grouped by bins first. The buckets of a variant are rows of equal charge bin,
    and in each row the nearest ones lie next to the trip's duration on either side: a cell
    meets one window entry a row (a charge bin is a multiple of its width up to 100 per cent,
    so there are few), never all buckets. Of these the nearest wins; ties go to the smaller
    bins. Unknown bins have no bucket.
    """
    binned = with_bins(trips, settings)
    spots = fleet.select("variant", F.col("soc_consumed_bin").alias("fs"), F.col("duration_bin").alias("fd"))
    cells = binned.where("duration_bin is not null and soc_consumed_bin is not null").select("variant", "duration_bin", "soc_consumed_bin").distinct()
    asked = cells.join(spots.select("variant", "fs").distinct(), "variant")
    both = asked.withColumn("fd", F.lit(None).cast("long")).withColumn("at", F.col("duration_bin")).unionByName(spots.withColumn("at", F.col("fd")), allowMissingColumns=True)
    row = Window.partitionBy("variant", "fs").orderBy("at")
    below, above = F.last("fd", ignorenulls=True).over(row), F.first("fd", ignorenulls=True).over(row.rangeBetween(0, Window.unboundedFollowing))
    sided = both.withColumns({"below": below, "above": above}).where("duration_bin is not null")
    closer = F.when(F.col("above").isNull() | (F.col("at") - F.col("below") <= F.col("above") - F.col("at")), F.col("below")).otherwise(F.col("above"))
    far = F.abs(F.col("duration_bin") - F.col("fd")) + F.abs(F.col("soc_consumed_bin") - F.col("fs"))
    best = F.min(F.struct("far", "fd", "fs")).alias("b")
    chosen = sided.withColumn("fd", closer).withColumn("far", far).groupBy("variant", "duration_bin", "soc_consumed_bin").agg(best).select("variant", "duration_bin", "soc_consumed_bin", "b.far", "b.fd", "b.fs")
    renamed = fleet.withColumnsRenamed({"duration_bin": "fd", "soc_consumed_bin": "fs"})
    return binned.join(chosen, ["variant", "duration_bin", "soc_consumed_bin"], "left").join(renamed, ["variant", "fd", "fs"], "left")


def attribute_rows(matched: DataFrame) -> DataFrame:
    """One row for each trip and shown attribute the trip has: vehicle, fleet, delta, per cent and band."""
    stack = ", ".join(f"'{a}', {a}, median_{a}" for a in SHOWN)
    long = matched.select(*TRIP, F.col("fd").isNotNull().alias("has"), F.expr(f"stack({len(SHOWN)}, {stack}) as (attr, vehicle, fleet)")).where("vehicle is not null")
    dev = deviation(F.col("vehicle"), F.col("fleet"))
    return long.withColumn("pct_dev", dev).select(*TRIP, "attr", "vehicle", "fleet", (F.col("vehicle") - F.col("fleet")).alias("delta"), "pct_dev", deviation_band(F.col("pct_dev"), F.col("has")).alias("flag"))


def detector_rows(matched: DataFrame) -> DataFrame:
    """One row for each trip and danger detector: events, dwell, fleet median and status."""
    stack = ", ".join(f"'{d}', {d}_events, {d}_max_dwell_s, median_{d}_events" for d in DANGER_DETECTORS)
    long = matched.select(*TRIP, F.expr(f"stack({len(DANGER_DETECTORS)}, {stack}) as (det, events, max_dwell_s, fleet_median)"))
    return long.withColumn("flag", detector_status(F.col("events"), F.col("fleet_median")))


def detector_rollup(rows: DataFrame) -> DataFrame:
    out = rows.groupBy(*VEHICLE, "det").agg(
        F.sum("events").alias("events_total"),
        F.max("max_dwell_s").alias("max_dwell_s"),
        F.coalesce(F.sum("fleet_median"), F.lit(0.0)).alias("fleet_total"),
        F.count("fleet_median").alias("fleet_buckets_n"),
        F.count_if(F.col("events") > 0).alias("trips_fired"),
    )
    return out.withColumn("flag", detector_status(F.col("events_total"), F.col("fleet_total"))).orderBy(*VEHICLE, F.desc("events_total"), "det")


def mean_deviation(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*VEHICLE, "attr").agg(F.avg("pct_dev").alias("mean_dev")).orderBy(*VEHICLE, F.desc(F.abs("mean_dev")), "attr")


def is_elevated():
    """Trip condition: a danger detector fired."""
    out = F.lit(False)
    for d in DANGER_DETECTORS:
        out = out | (F.coalesce(f"{d}_events", F.lit(0)) > 0)
    return out


def elevated_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy(*VEHICLE).agg(F.count("*").alias("n_trips"), F.count_if(is_elevated()).alias("n_elevated"))


def attribute_means(trips: DataFrame, mode: str | None = None, elevated: bool | None = None) -> DataFrame:
    """Averages of the shown attributes over a vehicle's trips, filtered by mode class and elevation."""
    part = trips
    if mode:
        part = part.where(mode_class() == mode)
    if elevated is not None:
        part = part.where(is_elevated() == elevated)
    return part.groupBy(*VEHICLE).agg(F.count("*").alias("n_trips"), *[F.avg(a).alias(a) for a in SHOWN])


def fleet_medians(fleet: DataFrame) -> DataFrame:
    """Median of bucket medians for each variant."""
    return exact_medians(fleet.select("variant", *[F.col(f"median_{a}").alias(a) for a in SHOWN]), ["variant"], SHOWN)


def vehicle_range(trips: DataFrame) -> DataFrame:
    """Mean km per per cent of charge: all, elevated and other trips."""
    ok = F.col("km_per_soc_pct") > 0
    k = F.col("km_per_soc_pct")
    return trips.groupBy(*VEHICLE).agg(
        F.avg(F.when(ok, k)).alias("all_trips"), F.avg(F.when(ok & is_elevated(), k)).alias("elevated"), F.avg(F.when(ok & ~is_elevated(), k)).alias("others")
    )


def fleet_range(records: DataFrame) -> DataFrame:
    """Median km per per cent of charge over nested trips of each variant."""
    k = F.col("t.km_per_soc_pct")
    ranges = staged(records.select("variant", F.explode("trips").alias("t")).where(k > 0).select("variant", k.alias("fleet_range")))
    return exact_medians(ranges, ["variant"], ["fleet_range"])


def elevated_rows(rows: DataFrame, trips: DataFrame, elevated_only: bool = True) -> DataFrame:
    """Raw rows (with ``trip_id``) of valid trips, or of elevated ones only."""
    chosen = trips.where(is_elevated()) if elevated_only else trips
    return rows.join(chosen.select(*TRIP), TRIP, "left_semi")


def time_in_buckets(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per cent of a group's readings in each bucket, to 2 places; readings below all buckets count in the total."""
    aggs = [F.count(s).alias(f"n_{s}") for s in SHARE_EDGES]
    for s, edges in SHARE_EDGES.items():
        for i, low in enumerate(edges):
            high = edges[i + 1] if i + 1 < len(edges) else None
            inside = (F.col(s) >= low) & (F.col(s) < high) if high is not None else F.col(s) >= low
            aggs.append(F.count_if(inside).alias(f"{s}_{i}"))
    wide = rows.groupBy(*keys).agg(*aggs)
    cells = [F.struct(F.lit(s).alias("signal"), F.lit(i).alias("bucket"), F.col(f"{s}_{i}").alias("n"), F.col(f"n_{s}").alias("total")) for s, e in SHARE_EDGES.items() for i in range(len(e))]
    return wide.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.signal", "c.bucket", F.bround(F.coalesce(F.try_divide(F.col("c.n") * 100.0, F.col("c.total")), F.lit(0.0)), 2).alias("pct"))


def pair_maps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """2-D shares over uneven edges: (keys, pair, y_bin, x_bin, pct), filled cells only."""
    cells = [F.struct(F.lit(f"{x}_vs_{y}").alias("pair"), uneven_bin(F.col(y), MAP_EDGES[y]).alias("y_bin"), uneven_bin(F.col(x), MAP_EDGES[x]).alias("x_bin")) for x, y in MAP_PAIRS]
    counted = (
        rows.select(*keys, F.explode(F.array(*cells)).alias("c"))
        .select(*keys, "c.*")
        .where("x_bin is not null and y_bin is not null")
        .groupBy(*keys, "pair", "y_bin", "x_bin")
        .agg(F.count("*").alias("n"))
    )
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*keys, "pair"))
    return counted.select(*keys, "pair", "y_bin", "x_bin", F.bround(share, 6).alias("pct"))
