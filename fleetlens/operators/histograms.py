"""Distributions, heat maps and totals behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.core import VEHICLE, edge_bin
from fleetlens.functions.quantiles import Wanted, exact_percentiles

# Signal: (low, high, bins); controller mode has one bin for each valid mode.
BINS = {"rpm": (0.0, 7000.0, 28), "torque": (0.0, 200.0, 20), "speed": (0.0, 80.0, 16), "throttle": (0.0, 10.0, 20), "current": (0.0, 300.0, 20), "temp": (0.0, 100.0, 20), "soc": (0.0, 100.0, 20)}
PAIRS = (("speed", (0.0, 80.0, 8), "rpm", (0.0, 7000.0, 10)), ("speed", (0.0, 80.0, 8), "throttle", (0.0, 10.0, 10)), ("speed", (0.0, 80.0, 8), "current", (0.0, 300.0, 10)), ("current", (0.0, 300.0, 10), "torque", (0.0, 200.0, 10)), ("temp", (0.0, 100.0, 10), "current", (0.0, 300.0, 10)))
STATS = ("rpm", "torque", "current", "speed", "throttle", "temp", "soc", "mode")


def _shares(counted: DataFrame, keys: list[str], cell: list[str]) -> DataFrame:
    """Per cent of the in-range rows of each group, to 3 places half-even."""
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*keys))
    return counted.select(*keys, *cell, F.bround(share, 3).alias("pct"))


def histograms(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, signal, bin, pct), filled bins only. Counts are partial before the shuffle."""
    cells = [F.struct(F.lit(s).alias("signal"), edge_bin(F.col(s), *b).alias("bin")) for s, b in BINS.items()]
    cells.append(F.struct(F.lit("mode").alias("signal"), F.when(F.col("mode").isin(0, 1), F.col("mode").cast("int")).alias("bin")))
    counted = rows.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.*").where("bin is not null").groupBy(*keys, "signal", "bin").agg(F.count("*").alias("n"))
    return _shares(counted, [*keys, "signal"], ["bin"])


def heatmaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pair, x_bin, y_bin, pct), filled cells only."""
    cells = [F.struct(F.lit(f"{x}_vs_{y}").alias("pair"), edge_bin(F.col(x), *xb).alias("x_bin"), edge_bin(F.col(y), *yb).alias("y_bin")) for x, xb, y, yb in PAIRS]
    counted = (
        rows.select(*keys, F.explode(F.array(*cells)).alias("c"))
        .select(*keys, "c.*")
        .where("x_bin is not null and y_bin is not null")
        .groupBy(*keys, "pair", "x_bin", "y_bin")
        .agg(F.count("*").alias("n"))
    )
    return _shares(counted, [*keys, "pair"], ["x_bin", "y_bin"])


def dense(shares: DataFrame, keys: list[str], bins: int, index: str = "bin") -> DataFrame:
    """Shares of one signal as one array a group, zeros where no row fell."""
    listed = shares.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(index, "pct"))).alias("m"))
    return listed.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))).alias("data"))


def labels(low: float, high: float, bins: int) -> list[str]:
    step = (high - low) / bins
    return [f"{low + i * step:g}-{low + (i + 1) * step:g}" for i in range(bins)]


def vehicle_stats(rows: DataFrame) -> DataFrame:
    """Mean, median and 90th percentile of each signal; modes other than 0 and 1 do not count."""
    valid = rows.withColumn("mode", F.when(F.col("mode").isin(0, 1), F.col("mode").cast("double")))
    stack = ", ".join(f"'{s}', cast({s} as double)" for s in STATS)
    long = valid.select(*VEHICLE, F.expr(f"stack({len(STATS)}, {stack}) as (signal, value)")).where("value is not null")
    out = long.groupBy(*VEHICLE, "signal").agg(F.avg("value").alias("mean"), F.percentile("value", F.array(F.lit(0.5), F.lit(0.9))).alias("p"))
    return out.select(*VEHICLE, "signal", "mean", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p90"))


def records(flags: DataFrame, rows: DataFrame) -> DataFrame:
    """Flag records with defaults; row counts of the telemetry where there are any."""
    counted = rows.groupBy(*VEHICLE).agg(F.count("*").alias("rows"))
    zero = lambda c, z: F.coalesce(F.col(c), F.lit(z)).alias(c)
    return flags.join(counted, list(VEHICLE), "left").select(
        *VEHICLE, zero("cluster_id", 0), zero("distance_to_center", 0.0), zero("cluster_outlier", False), zero("isolation_score", 0.0), zero("isolation_outlier", False),
        zero("is_anomaly", False), zero("severity", "NORMAL"), zero("severity_tier", 0), F.coalesce("rows", "n_records", F.lit(0)).alias("n_records"),
    )


def cluster_summary(recs: DataFrame) -> DataFrame:
    """One row a variant: counts, dense cluster sizes and the distance that marks outliers."""
    sizes = recs.groupBy("variant", "cluster_id").agg(F.count("*").alias("n")).groupBy("variant").agg(F.map_from_entries(F.collect_list(F.struct("cluster_id", "n"))).alias("m"), F.max("cluster_id").alias("top"), F.count("*").alias("n_clusters"))
    dense_sizes = F.transform(F.sequence(F.lit(0), F.col("top")), lambda i: F.coalesce(F.col("m")[i], F.lit(0)))
    totals = recs.groupBy("variant").agg(
        F.count("*").alias("n_vehicles"),
        F.sum("n_records").alias("n_records"),
        F.count_if("is_anomaly").alias("n_anomalies"),
        F.count_if(F.col("severity") == "HIGH").alias("n_high_severity"),
        F.count_if(F.col("severity") == "MEDIUM").alias("n_medium_severity"),
    )
    far = exact_percentiles(recs, ["variant"], [Wanted("far", F.col("distance_to_center"), (0.9,))]).select("variant", F.col("far")[0].alias("distance_threshold"))
    return totals.join(sizes, "variant").join(far, "variant").select("variant", "n_vehicles", "n_records", "n_clusters", dense_sizes.alias("cluster_sizes"), "distance_threshold", "n_anomalies", "n_high_severity", "n_medium_severity")


def totals(clusters: DataFrame) -> DataFrame:
    return clusters.agg(
        F.sum("n_vehicles").alias("total_vehicles"),
        F.sum("n_anomalies").alias("total_anomalies"),
        F.sum("n_high_severity").alias("high"),
        F.sum("n_medium_severity").alias("medium"),
        F.sum(F.col("n_vehicles") - F.col("n_high_severity") - F.col("n_medium_severity")).alias("normal"),
        F.count("*").alias("n_variants"),
    )
