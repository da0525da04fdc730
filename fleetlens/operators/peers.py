"""Usage peers, peer scores, verdicts and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, DETECTORS, MATCH_FEATURES, VERDICTS, Settings
from fleetlens.functions.core import VEHICLE, verdict_rank, verdict_severity
from fleetlens.functions.quantiles import Wanted, between, exact_percentiles
from fleetlens.functions.shared import small, staged
from fleetlens.operators import nearest

# Fields of a trip in a verdict, in their order.
TRIP_FIELDS = (
    "trip_id", "duration_min", "dist_km", "avg_speed", "mean_speed", "p90_speed", "median_torque", "p90_torque", "median_throttle", "p90_throttle", "low_speed_frac", "soc_start",
    "soc_end", "soc_consumed", "km_per_soc_pct", "peak_temp", "temp_delta_c", "current_per_speed", "current_per_torque", "current_spike_rate", "high_temp_rate", "mode_0_frac", "mode_1_frac",
)


def _scale(mad: Column, iqr: Column, sd: Column) -> Column:
    return F.greatest(F.when(mad > 0, mad).when(iqr > 0, iqr / 1.349).when(sd > 0, sd).otherwise(1.0), F.lit(1e-9))


def robust_scale(long: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Median and scale of ``value`` for each key group: (keys, med, scale).

    Scale: 1.4826 times the median absolute deviation; if that is 0, IQR / 1.349; if
    that is 0 too, the population deviation, or 1 if there is none; 1e-9 at least.
    Groups of any size, for which ``long`` is read several times.
    """
    known = long.where(F.col(value).isNotNull())
    first = staged(exact_percentiles(known, keys, [Wanted("q", F.col(value), (0.25, 0.5, 0.75))]).join(known.groupBy(*keys).agg(F.stddev_pop(value).alias("sd")), keys))
    off = known.join(first, keys).withColumn("off", F.abs(F.col(value) - F.col("q")[1]))
    middle = exact_percentiles(off, keys, [Wanted("mid", F.col("off"), (0.5,))])
    spread = first.join(middle, keys)
    return spread.select(*keys, F.col("q")[1].alias("med"), _scale(F.col("mid")[0] * 1.4826, F.col("q")[2] - F.col("q")[0], F.col("sd")).alias("scale"))


def scaled_features(profiles: DataFrame) -> DataFrame:
    """(variant, imei, v): match features scaled once for each variant; missing ones sit at the median.

    Candidates and target together are always the whole variant, so centre and scale
    do not depend on the target.
    """
    stack = ", ".join(f"'{f}', {f}" for f in MATCH_FEATURES)
    long = profiles.select(*VEHICLE, F.expr(f"stack({len(MATCH_FEATURES)}, {stack}) as (feature, value)"))
    scaled = long.join(robust_scale(long, ["variant", "feature"]), ["variant", "feature"], "left")
    z = F.coalesce((F.col("value") - F.col("med")) / F.col("scale"), F.lit(0.0))
    wide = scaled.withColumn("z", z).groupBy(*VEHICLE).pivot("feature", list(MATCH_FEATURES)).agg(F.first("z"))
    return wide.select(*VEHICLE, F.array(*MATCH_FEATURES).alias("v"))


def find_peers(profiles: DataFrame, settings: Settings = DEFAULT, block: int = nearest.TILE) -> DataFrame:
    """(variant, imei, peer, distance, rank): nearest vehicles of the variant, exactly.

    Cells around pivots and the triangle inequality leave out most pairs (see
    ``operators.nearest``), in tiles of ``block`` candidates. Variants with too few candidates have no peers. Distances are
    rounded before ordering so that ties break by id everywhere.
    """
    v = staged(scaled_features(profiles))
    sizes = v.groupBy("variant").agg(F.count("*").alias("pool")).where(F.col("pool") > settings.min_peers)
    found = nearest.nearest(v.join(small(staged(sizes)), "variant").select(F.col("variant").alias("grp"), F.col("imei").alias("id"), "v"), settings.peers, block)
    return found.withColumnsRenamed({"grp": "variant", "id": "imei"})


def peer_scores(profiles: DataFrame, peers: DataFrame) -> DataFrame:
    """(variant, imei, det, rate, z, peer_p95) of every vehicle with peers.

    The eight rates of a peer travel as one row, and once: each vehicle's rates of at most
    k peers are sorted arrays, from which the scale (as in ``robust_scale``) is read.
    """
    key = list(VEHICLE)
    rates = profiles.select(*key, *[f"{d}_rate" for d in DETECTORS])
    of_peers = peers.select(*key, "peer").join(rates.withColumnRenamed("imei", "peer"), ["variant", "peer"])
    held = of_peers.groupBy(*key).agg(*[F.struct(F.sort_array(F.collect_list(f"{d}_rate")).alias("x"), F.stddev_pop(f"{d}_rate").alias("sd")).alias(f"{d}_of") for d in DETECTORS])
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("det"), F.col(f"{d}_rate").alias("rate"), F.col(f"{d}_of.x").alias("x"), F.col(f"{d}_of.sd").alias("sd")) for d in DETECTORS]))

    def at(x: str, share: float) -> Column:
        rank = (F.size(x) - 1) * F.lit(share)
        return between(rank, F.get(x, F.floor(rank).cast("int")), F.get(x, F.ceil(rank).cast("int")))

    off = F.array_sort(F.transform("x", lambda v: F.abs(v - F.col("med"))))
    return (
        rates.join(held, key)
        .select(*key, each.alias("s"))
        .select(*key, "s.*")
        .where(F.col("rate").isNotNull() & (F.size("x") > 0))
        .withColumns({"med": at("x", 0.5), "iqr": at("x", 0.75) - at("x", 0.25), "peer_p95": at("x", 0.95)})
        .withColumn("off", off)
        .select(*key, "det", "rate", ((F.col("rate") - F.col("med")) / _scale(at("off", 0.5) * 1.4826, F.col("iqr"), F.col("sd"))).alias("z"), "peer_p95")
    )


def strong(scores: DataFrame, flags: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Scores of flagged-stage vehicles with ``strong`` and its reason."""
    limit = F.when(F.col("is_anomaly"), settings.z_flagged).otherwise(settings.z_unflagged)
    # Rounded so that a score on the limit falls the same way everywhere.
    by_z = F.round("z", 9) >= limit
    by_rate = (F.col("rate") > 0) & (F.col("rate") >= F.col("peer_p95"))
    return scores.join(flags.select(*VEHICLE, "is_anomaly"), list(VEHICLE)).withColumns(
        {"strong": by_z | by_rate, "strong_reason": F.when(by_z, "z").when(by_rate, "rate_p95").otherwise("")}
    )


def spirited(trips: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(variant, imei, fast_share, median_p90, spirited)."""
    out = trips.groupBy(*VEHICLE).agg(F.avg((F.col("mean_speed") > settings.spirited_mean).cast("double")).alias("fast_share"), F.median("p90_speed").alias("median_p90"))
    return out.withColumn("spirited", F.coalesce((F.col("fast_share") >= settings.spirited_share) & (F.col("median_p90") >= settings.spirited_p90), F.lit(False)))


def gate(flag: Column, n_strong: Column, fast: Column, enough: Column, settings: Settings = DEFAULT) -> Column:
    """Verdict and reason as a struct; the first rule that holds decides."""
    v = lambda verdict, reason: F.struct(F.lit(verdict).alias("verdict"), F.lit(reason).alias("reason"))
    calm = v("NORMAL", "SPIRITED_DRIVER_HIGH_SPEED_HIGH_RPM")
    return (
        F.when(~enough & fast, calm)
        .when(~enough & flag, v("WATCH", "INSUFFICIENT_PEERS"))
        .when(~enough, v("NORMAL", "INSUFFICIENT_PEERS"))
        .when(fast & (n_strong <= settings.spirited_max_strong), calm)
        .when(flag & (n_strong >= settings.strong_with_flag), v("ELEVATED", "ML_AND_DUAL"))
        .when(~flag & (n_strong == 0), v("NORMAL", "NO_ML_NO_DUAL"))
        .when(flag & (n_strong == 0), v("WATCH", "ML_ONLY_PATTERN"))
        .when(flag & (n_strong == 1), v("WATCH", "ML_PLUS_ONE_DUAL"))
        .when(~flag & (n_strong >= 1), v("WATCH", "PHYSICS_ONLY_NO_ML"))
        .otherwise(v("WATCH", "PARTIAL_EVIDENCE"))
    )


def verdicts(flags: DataFrame, profiles: DataFrame, trips: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Graded record of every flagged-stage vehicle with a valid trip; peers come from all profiles."""
    peers = staged(find_peers(profiles, settings))
    scored = staged(strong(peer_scores(profiles, peers), flags, settings))
    by_vehicle = scored.groupBy(*VEHICLE).agg(
        F.map_from_entries(F.collect_list(F.struct("det", F.struct(F.bround("z", 3).alias("z"), "strong")))).alias("s"),
        F.array_sort(F.collect_list(F.when(F.col("strong"), F.concat("det", F.lit("_rate"))))).alias("strong_metric_ids"),
    )
    n_peers = peers.groupBy(*VEHICLE).agg(F.count("*").alias("n_peers"))
    key = list(VEHICLE)
    joined = (
        flags.select(*key, F.col("is_anomaly").alias("detector_flag"), "isolation_score", "cluster_id")
        .join(profiles, key)
        .join(n_peers, key, "left")
        .join(by_vehicle, key, "left")
        .join(spirited(trips, settings).select(*key, "spirited"), key, "left")
        .na.fill({"n_peers": 0})
    )
    ids = F.coalesce("strong_metric_ids", F.array().cast("array<string>"))
    decided = gate(F.col("detector_flag"), F.size(ids), F.col("spirited"), F.col("n_peers") >= settings.min_peers, settings)
    label = F.create_map(*[F.lit(x) for d, t in DETECTORS.items() for x in (f"{d}_rate", t)])
    per_det = []
    for d in DETECTORS:
        per_det += [
            F.col(f"{d}_events_total"),
            F.bround(f"{d}_max_dwell_s", 2).alias(f"{d}_max_dwell_s"),
            F.bround(f"{d}_rate", 4).alias(f"{d}_rate"),
            F.col("s")[d]["z"].alias(f"{d}_z"),
            F.coalesce(F.col("s")[d]["strong"], F.lit(False)).alias(f"{d}_strong"),
        ]
    return joined.withColumn("strong_metric_ids", ids).withColumn("g", decided).select(
        "imei", "variant", "detector_flag", "isolation_score", "cluster_id",
        F.col("g.verdict").alias("verdict"), F.col("g.reason").alias("watch_reason"),
        F.array_join(F.transform("strong_metric_ids", lambda i: label[i]), " | ").alias("reason"),
        "n_trips", "n_peers", F.bround("drive_hours", 3).alias("drive_hours"), F.bround("charge_hours", 3).alias("charge_hours"),
        F.size("strong_metric_ids").alias("strong_metric_count"), "strong_metric_ids", "spirited",
        F.bround("mode_0_frac", 4).alias("mode_0_frac"), F.bround("mode_1_frac", 4).alias("mode_1_frac"), *per_det,
    )


def nested_trips(trips: DataFrame) -> DataFrame:
    """(variant, imei, trips): each vehicle's trips in order. One vehicle's trips are bounded by its history."""
    return trips.groupBy(*VEHICLE).agg(F.sort_array(F.collect_list(F.struct(*TRIP_FIELDS))).alias("trips"))


def with_trips(records: DataFrame, trips: DataFrame) -> DataFrame:
    return records.join(nested_trips(trips), list(VEHICLE), "left")


def data_gaps(flags: DataFrame, profiles: DataFrame) -> DataFrame:
    """Flagged-stage vehicles without a valid trip."""
    return flags.join(profiles.select(*VEHICLE), list(VEHICLE), "left_anti")


def ordered(records: DataFrame) -> DataFrame:
    return records.orderBy(verdict_rank(F.col("verdict")), F.desc("strong_metric_count"), "variant", "imei")


def verdict_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("verdict").agg(F.count("*").alias("n"))


def reason_counts(records: DataFrame, only_watch: bool = False) -> DataFrame:
    part = records.where("verdict = 'WATCH'") if only_watch else records
    reason = F.when(F.coalesce("watch_reason", F.lit("")) == "", "UNSPECIFIED").otherwise(F.col("watch_reason"))
    return part.groupBy(reason.alias("watch_reason")).agg(F.count("*").alias("n"))


def crosstab(records: DataFrame) -> DataFrame:
    return records.groupBy("variant").pivot("verdict", list(VERDICTS)).agg(F.count(F.lit(1))).na.fill(0)


def breakdown(records: DataFrame, top: int | None = None) -> DataFrame:
    """Variants by elevated count, total and name; the first ``top`` of them if given."""
    table = crosstab(records).withColumn("total", sum((F.col(v) for v in VERDICTS), F.lit(0)))
    out = table.orderBy(F.desc("ELEVATED"), F.desc("total"), "variant")
    return out.limit(top) if top else out


def _counts() -> list[Column]:
    """Aggregates of the counts of both older report forms."""
    c = F.count_if
    v = F.col("verdict")
    return [
        F.count("*").alias("total_validated"),
        c(F.col("detector_flag")).alias("detector_flagged"),
        c(v == "ELEVATED").alias("elevated"),
        c(v == "WATCH").alias("watch"),
        c(v.isin("ELEVATED", "WATCH")).alias("watchlist_total"),
        c(v == "NORMAL").alias("normal_after_validation"),
        c(F.col("spirited")).alias("spirited_total"),
        c(F.col("spirited") & (v == "NORMAL")).alias("spirited_demoted_to_normal"),
        c(F.col("watch_reason").isin("DATA_GAP_NO_VALID_TRIPS", "NO_VALID_TRIPS")).alias("no_valid_trips"),
        F.coalesce(F.sum("n_trips"), F.lit(0)).alias("valid_trips"),
        c(F.col("n_trips") > 0).alias("vehicles_with_valid_trips"),
    ]


def summary(records: DataFrame) -> DataFrame:
    """One row: the counts of both older report forms."""
    return records.agg(*_counts())


def summary_record(records: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The nested summary: counts, maps of counts and parameters, in one row.

    One aggregate of the records by grouping sets (total, verdict, reason, variant and
    verdict); its few rows are then put into maps. Without records all maps are empty.
    """
    reason = F.when(F.coalesce("watch_reason", F.lit("")) == "", "UNSPECIFIED").otherwise(F.col("watch_reason"))
    named = records.select("variant", F.col("verdict").alias("by_verdict"), reason.alias("by_reason"), "verdict", "watch_reason", "detector_flag", "spirited", "n_trips")
    v, r, m = F.col("variant"), F.col("by_reason"), F.col("by_verdict")
    sets = named.groupingSets([[], [m], [r], [v, m]], v, r, m).agg(F.grouping_id().alias("level"), *_counts())
    # Bits of the level, from the left: variant, reason and verdict are summed over.
    total, verdicts_, reasons, crossed = 7, 6, 5, 2
    entry = lambda level, key, value: F.map_from_entries(F.collect_list(F.when(F.col("level") == level, F.struct(key, value))))
    n = F.col("total_validated")
    per_variant = sets.withColumn("n", n).groupBy("level", "variant").agg(
        *[F.max(F.when(F.col("level") == total, F.col(c.name))).alias(c.name) for c in summary(records).schema],
        F.array_sort(F.collect_list(F.struct(F.coalesce("by_verdict", "by_reason", F.lit("")).alias("key"), "n"))).alias("entries"),
    )
    maps = [entry(level, F.lit(""), F.map_from_entries("entries")) for level in (verdicts_, reasons)]
    out = per_variant.agg(
        *[F.coalesce(F.max(c.name), F.lit(0)).alias(c.name) for c in summary(records).schema],
        *[F.coalesce(F.element_at(m_, F.lit("")), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))).alias(name) for m_, name in zip(maps, ("verdict_counts", "watch_reason_counts"))],
        entry(crossed, F.col("variant"), F.map_from_entries("entries")).alias("variant_verdict_counts"),
    )
    return out.withColumn("pipeline_version", F.lit(settings.version))


def listed(records: DataFrame, verdict: str | None = None, variant: str | None = None, text: str = "", most: int = 500) -> DataFrame:
    """The list view: filters, a case-folded search in id or variant, ``most`` rows at the most."""
    out = records
    if verdict:
        out = out.where(F.col("verdict") == verdict)
    if variant:
        out = out.where(F.col("variant") == variant)
    if text:
        q = text.lower()
        out = out.where(F.lower("imei").contains(q) | F.lower("variant").contains(q))
    return ordered(out).limit(most)


def targets(records: DataFrame, verdict: str = "ELEVATED", variant: str | None = None) -> DataFrame:
    """Vehicles of a batch report, most strong detectors first."""
    out = records.where(F.col("verdict") == verdict)
    return (out.where(F.col("variant") == variant) if variant else out).orderBy(F.desc("strong_metric_count"), "variant", "imei")


def legacy(records: DataFrame) -> DataFrame:
    """Records of the older form: severity, readable metrics and empty defaults."""
    label = F.create_map(*[F.lit(x) for d, t in DETECTORS.items() for x in (f"{d}_rate", t)])
    return records.withColumns(
        {
            "severity": verdict_severity(F.col("verdict")),
            "strong_metrics": F.array_join(F.transform("strong_metric_ids", lambda i: label[i]), "; "),
            "review_recommendation": F.lit(""),
            "timeline": F.lit(None).cast("string"),
        }
    )
