"""Registered queries over proxy telemetry, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import DANGER_DETECTORS, DETECTORS, PROXY
from fleetlens.functions.core import VEHICLE, half_even_bin, mode_class, verdict_severity
from fleetlens.functions.positions import positioned
from fleetlens.functions.shared import staged
from fleetlens.operators import detectors, explain, fleet, forms, histograms, ml, peers, sessions, trips
from fleetlens.operators.fleet import ATTRIBUTES, EVENT_ATTRIBUTES, SHOWN
from fleetlens.operators.ml import FEATURES
from fleetlens.plans import oracle
from fleetlens.plans import oracle as O
from fleetlens.plans.oracle import T, V, build, rnd, rows
from fleetlens.sources import proxy, sinks, synthetic, telemetry

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 places. The small shift keeps short decimals off the halves, which engines round differently."""
    return df.select(*[(F.round(F.col(c) + F.lit(oracle.SHIFT), 6) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class Base:
    """The usual intermediate tables of one input folder, as lazy plans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def rows(self) -> DataFrame:
        return proxy.telemetry(self.spark, self.sf_dir)

    @cached_property
    def held(self) -> DataFrame:
        """The rows in buckets of vehicles: trips and charges read them from there, twice each, and shuffle none of them again."""
        return proxy.bucketed_telemetry(self.spark, self.sf_dir)

    @cached_property
    def thresholds(self) -> DataFrame:
        return staged(detectors.variant_thresholds(self.rows, PROXY))

    @cached_property
    def trips(self) -> DataFrame:
        return staged(trips.trip_table(self.held, self.thresholds, PROXY, whole=True))

    @cached_property
    def charges(self) -> DataFrame:
        return trips.charge_summary(self.held, self.thresholds, PROXY, whole=True)

    @cached_property
    def profiles(self) -> DataFrame:
        return staged(trips.profiles(self.trips, self.charges))

    @cached_property
    def flags(self) -> DataFrame:
        vehicles = self.rows.groupBy(*VEHICLE).agg(F.count_if(F.col("state") == 2).alias("n_records"))
        return staged(proxy.injected_flags(self.spark, self.sf_dir, vehicles))

    @cached_property
    def drive(self) -> DataFrame:
        return sessions.fleet_source_rows(self.rows)

    @cached_property
    def verdicts(self) -> DataFrame:
        return peers.verdicts(self.flags, self.profiles, self.trips, PROXY)

    @cached_property
    def fleet(self) -> DataFrame:
        return staged(fleet.reference(self.trips, PROXY))

    @cached_property
    def matched(self) -> DataFrame:
        return fleet.nearest_bucket(self.trips, self.fleet, PROXY)


# Cleaning and row filters


@query("""WITH r AS (SELECT CASE l_linenumber % 6 WHEN 0 THEN l_suppkey || '.0' WHEN 1 THEN CAST(l_suppkey AS VARCHAR) WHEN 2 THEN NULL WHEN 3 THEN 'ID-' || l_suppkey WHEN 4 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS imei0, *
  FROM lineitem WHERE l_orderkey % 17 <> 0 AND l_partkey % 19 <> 0)
SELECT l_returnflag || ' | ' || l_linestatus AS variant, replace(imei0, '.0', '') AS imei, l_shipdate AS time, l_orderkey * 8 + l_linenumber AS seq,
  CASE WHEN l_partkey % 7 = 0 OR l_partkey % 11 = 0 OR l_partkey % 13 = 0 THEN NULL ELSE trunc(l_quantity) END AS speed, CASE WHEN l_linenumber % 2 = 0 THEN 50.0 ELSE 100.0 END AS soc,
  CAST(CASE l_linenumber % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE NULL END AS SMALLINT) AS state, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE NULL END AS SMALLINT) AS mode FROM r WHERE imei0 IS NOT NULL""")
def clean_telemetry(spark, sf_dir):
    return telemetry.clean(proxy.raw_telemetry(spark, sf_dir)).select("variant", "imei", "time", "seq", "speed", "soc", "state", "mode")


@query("SELECT l_returnflag || ' | ' || l_linestatus AS variant, count(*) AS n FROM lineitem WHERE l_orderkey % 17 <> 0 AND l_partkey % 19 <> 0 AND l_linenumber % 6 NOT IN (2, 4) AND l_returnflag IN ('A', 'R') GROUP BY 1")
def model_whitelist(spark, sf_dir):
    from dataclasses import replace

    return telemetry.clean(proxy.raw_telemetry(spark, sf_dir), replace(PROXY, models=("A", "R"))).groupBy("variant").agg(F.count("*").alias("n"))


@query(build(f"SELECT {V}, count(*) FILTER (WHERE state = 2) AS driving, count(*) FILTER (WHERE state = 2 AND coalesce(speed, 0) > 0) AS moving, count(*) FILTER (WHERE state = 1) AS charging FROM tele GROUP BY {V}", "tele"))
def state_rows(spark, sf_dir):
    r = proxy.telemetry(spark, sf_dir)
    parts = {"driving": sessions.driving(r), "moving": sessions.moving(r), "charging": sessions.charging(r)}
    marked = reduce(DataFrame.unionByName, [p.select(*VEHICLE, F.lit(k).alias("kind")) for k, p in parts.items()])
    return r.select(*VEHICLE).distinct().join(marked.groupBy(*VEHICLE).pivot("kind", list(parts)).agg(F.count(F.lit(1))), list(VEHICLE), "left").na.fill(0)


@query(build(f"SELECT {V}, count(*) AS n, {rnd('avg(rpm / speed)', 'mean_ratio')} FROM tele WHERE speed > 3 AND rpm > 50 GROUP BY {V}", "tele"))
def ratio_gate(spark, sf_dir):
    return sessions.ratio_rows(proxy.telemetry(spark, sf_dir)).groupBy(*VEHICLE).agg(F.count("*").alias("n"), F.avg("rpm_per_speed").alias("mean_ratio"))


@query(build("SELECT variant, count(*) AS n FROM src GROUP BY variant", "src"))
def threshold_source_rows(spark, sf_dir):
    return sessions.source_rows(proxy.telemetry(spark, sf_dir), PROXY).groupBy("variant").agg(F.count("*").alias("n"))


@query(build("SELECT variant, count(*) AS n, count(*) FILTER (WHERE mode IN (0, 1)) AS valid_mode FROM drv GROUP BY variant", "drv"))
def chart_source_rows(spark, sf_dir):
    return sessions.fleet_source_rows(proxy.telemetry(spark, sf_dir)).groupBy("variant").agg(F.count("*").alias("n"), F.count_if(F.col("mode").isin(0, 1)).alias("valid_mode"))


@query(build("SELECT count(DISTINCT imei) AS vehicles, count(DISTINCT variant) AS variants, count(*) AS n FROM tele", "tele"))
def distinct_counts(spark, sf_dir):
    return proxy.telemetry(spark, sf_dir).agg(F.countDistinct("imei").alias("vehicles"), F.countDistinct("variant").alias("variants"), F.count("*").alias("n"))


# Thresholds, sessions and detectors


@query(build(f"SELECT variant, {O.ALL_THRESHOLDS} FROM stats", "stats"))
def variant_thresholds(spark, sf_dir):
    return detectors.variant_thresholds(proxy.telemetry(spark, sf_dir), PROXY)


@query(build(f"SELECT {T}, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM tr GROUP BY {T}", "tr"))
def trip_segments(spark, sf_dir):
    return sessions.trips_of(proxy.telemetry(spark, sf_dir), PROXY).groupBy(*VEHICLE, "trip_id").agg(F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


@query(build(f"SELECT {V}, session_id, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM ses GROUP BY {V}, session_id", "ses"))
def charge_sessions(spark, sf_dir):
    return sessions.charge_sessions_of(proxy.telemetry(spark, sf_dir), PROXY).groupBy(*VEHICLE, "session_id").agg(F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


_EVENT_SESSIONS = """WITH g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CAST(sum(CASE WHEN gap > 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS INT) AS session_id FROM g)
"""


@query(_EVENT_SESSIONS + f"SELECT user_id, session_id, count(*) AS n, min(ts) AS first_time, max(ts) AS last_time, {rnd('round(sum(value), 4)', 'total')} FROM s GROUP BY user_id, session_id")
def event_sessions(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return sessions.gap_sessions(e, "user_id", "ts", 21600, "event_id").groupBy("user_id", "session_id").agg(F.count("*").alias("n"), F.min("ts").alias("first_time"), F.max("ts").alias("last_time"), F.round(F.sum("value"), 4).alias("total"))


@query(_EVENT_SESSIONS + "SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 6 HOUR AS ended, count(*) AS n FROM s GROUP BY user_id, session_id")
def session_window(spark, sf_dir):
    """The built-in session window; in batch a gap of exactly the limit stays in one session."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


@query(build(f"SELECT {T}, {rnd('duration_min')} FROM raw", "raw"))
def active_duration(spark, sf_dir):
    r = sessions.trips_of(proxy.telemetry(spark, sf_dir), PROXY).withColumn("trip_gap_units", F.col("gap"))
    return r.groupBy(*VEHICLE, "trip_id").agg(trips.active_minutes(PROXY).alias("duration_min"))


@query(build(f"SELECT {T}, {rnd('soc_start')}, {rnd('soc_end')}, {rnd('dist_km')} FROM raw", "raw"))
def first_last(spark, sf_dir):
    return trips.raw_trip_metrics(sessions.trips_of(proxy.telemetry(spark, sf_dir), PROXY), PROXY).select(*VEHICLE, "trip_id", "soc_start", "soc_end", "dist_km")


def _detector(det: str) -> None:
    unit = f"{V}, session_id" if det.startswith("d7") else T

    def run(spark, sf_dir):
        return detectors.events_of(proxy.telemetry(spark, sf_dir), det, PROXY)

    run.__name__ = f"detector_{det}"
    query(build(f"SELECT {unit}, det, events, {rnd('max_dwell_s')}, {rnd('mean_dwell_s')} FROM {'ev7' if det.startswith('d7') else 'ev'} WHERE det = '{det}'", "ev7" if det.startswith("d7") else "ev"))(run)


for _d in DETECTORS:
    _detector(_d)


@query(build(f"SELECT det, count(*) AS units, CAST(sum(events) AS BIGINT) AS events, {rnd('max(max_dwell_s)', 'max_dwell_s')} FROM (SELECT det, events, max_dwell_s FROM ev UNION ALL SELECT det, events, max_dwell_s FROM ev7) GROUP BY det", "ev", "ev7"))
def detectors_all(spark, sf_dir):
    r = proxy.telemetry(spark, sf_dir)
    t = staged(detectors.variant_thresholds(r, PROXY))
    both = detectors.trip_events(sessions.trips_of(r, PROXY), t, PROXY).drop("trip_id").unionByName(detectors.charge_events(sessions.charge_sessions_of(r, PROXY), t, PROXY).drop("session_id"))
    return both.groupBy("det").agg(F.count("*").alias("units"), F.sum("events").alias("events"), F.max("max_dwell_s").alias("max_dwell_s"))


@query(build(f"SELECT {V}, CAST(sum(events) AS BIGINT) AS events, {rnd('max(max_dwell_s)', 'max_dwell_s')} FROM ev WHERE det = 'd2_throttle_speed' GROUP BY {V}", "ev"))
def sustained_throttle_low_speed(spark, sf_dir):
    """Vehicles that hold throttle high while speed is low, against their own variant."""
    return detectors.events_of(proxy.telemetry(spark, sf_dir), "d2_throttle_speed", PROXY).groupBy(*VEHICLE).agg(F.sum("events").alias("events"), F.max("max_dwell_s").alias("max_dwell_s"))


# Trips, charging and profiles


@query(build(f"SELECT {O.trip_columns()} FROM trips", "trips"))
def trip_table(spark, sf_dir):
    return Base(spark, sf_dir).trips


@query(build(f"SELECT {V}, count(*) AS trips, count(*) FILTER (WHERE n_rows < 2) AS too_few, count(*) FILTER (WHERE duration_min < {PROXY.min_minutes}) AS too_short, count(*) FILTER (WHERE dist_km < {PROXY.min_km}) AS too_near, count(*) FILTER (WHERE km_per_soc_pct > {PROXY.max_km_per_soc}) AS implausible FROM met GROUP BY {V}", "met"))
def trip_gates(spark, sf_dir):
    m = trips.raw_trip_metrics(sessions.trips_of(proxy.telemetry(spark, sf_dir), PROXY), PROXY)
    return m.groupBy(*VEHICLE).agg(
        F.count("*").alias("trips"),
        F.count_if(F.col("n_rows") < 2).alias("too_few"),
        F.count_if(F.col("duration_min") < PROXY.min_minutes).alias("too_short"),
        F.count_if(F.col("dist_km") < PROXY.min_km).alias("too_near"),
        F.count_if(F.col("km_per_soc_pct") > PROXY.max_km_per_soc).alias("implausible"),
    )


@query(build(f"SELECT {V}, d7_events, {rnd('d7_max_dwell_s')}, {rnd('charge_hours')} FROM charges", "charges"))
def charge_summary(spark, sf_dir):
    return Base(spark, sf_dir).charges


@query(build(f"SELECT {V}, n_trips, {rows(O.MATCH_FEATURES)}, {rnd('drive_hours')}, {rnd('charge_hours')}, " + ", ".join(f"{rnd(f'{d}_rate')}, {d}_events_total, {rnd(f'{d}_max_dwell_s')}" for d in DETECTORS) + " FROM prof", "prof"))
def profiles(spark, sf_dir):
    return Base(spark, sf_dir).profiles


# Peers, scores and verdicts


@query(build(f"SELECT variant, feature, {rnd('med')}, {rnd('scale')} FROM pscale", "pscale"))
def robust_scale(spark, sf_dir):
    stack = ", ".join(f"'{f}', {f}" for f in O.MATCH_FEATURES)
    long = Base(spark, sf_dir).profiles.select(*VEHICLE, F.expr(f"stack({len(O.MATCH_FEATURES)}, {stack}) as (feature, value)"))
    return peers.robust_scale(long, ["variant", "feature"])


@query(build(f"SELECT {V}, peer, {rnd('distance')}, rank FROM peers", "peers"))
def nearest_peers(spark, sf_dir):
    return peers.find_peers(Base(spark, sf_dir).profiles, PROXY)


@query(build(f"SELECT {V}, det, {rnd('rate')}, {rnd('z')}, {rnd('peer_p95')} FROM score", "score"))
def peer_scores(spark, sf_dir):
    b = Base(spark, sf_dir)
    return peers.peer_scores(b.profiles, peers.find_peers(b.profiles, PROXY))


@query(build(f"SELECT {V}, det, strong, strong_reason FROM strong", "strong"))
def strong_detectors(spark, sf_dir):
    b = Base(spark, sf_dir)
    return peers.strong(peers.peer_scores(b.profiles, peers.find_peers(b.profiles, PROXY)), b.flags, PROXY).select(*VEHICLE, "det", "strong", "strong_reason")


@query(build(f"SELECT {V}, {rnd('fast_share')}, {rnd('median_p90')}, spirited FROM spir", "spir"))
def spirited_drivers(spark, sf_dir):
    return peers.spirited(Base(spark, sf_dir).trips, PROXY)


def _flat(v: DataFrame) -> DataFrame:
    drop = [c for d in DETECTORS for c in (f"{d}_z", f"{d}_strong")]
    return v.drop(*drop).withColumn("strong_metric_ids", F.array_join("strong_metric_ids", ","))


@query(build(f"SELECT {O.verdict_columns()} FROM ver", "ver"))
def verdicts(spark, sf_dir):
    return _flat(Base(spark, sf_dir).verdicts)


@query(build(f"SELECT f.variant, f.imei FROM flags f LEFT JOIN (SELECT * FROM prof WHERE n_trips >= 8) p USING ({V}) WHERE p.imei IS NULL", "flags", "prof"))
def data_gaps(spark, sf_dir):
    """Vehicles without enough valid trips; every proxy vehicle has one, so the query asks for eight."""
    b = Base(spark, sf_dir)
    return peers.data_gaps(b.flags, b.profiles.where("n_trips >= 8")).select(*VEHICLE)


@query(build("SELECT verdict, count(*) AS n FROM ver GROUP BY verdict", "ver"))
def verdict_counts(spark, sf_dir):
    return peers.verdict_counts(Base(spark, sf_dir).verdicts)


@query(build("SELECT watch_reason, count(*) AS n FROM ver GROUP BY 1", "ver"))
def reason_counts(spark, sf_dir):
    return peers.reason_counts(Base(spark, sf_dir).verdicts)


@query(build("SELECT watch_reason, count(*) AS n FROM ver WHERE verdict = 'WATCH' GROUP BY 1", "ver"))
def watch_reason_counts(spark, sf_dir):
    return peers.reason_counts(Base(spark, sf_dir).verdicts, only_watch=True)


_CROSS = ", ".join(f"count(*) FILTER (WHERE verdict = '{v}') AS \"{v}\"" for v in ("ELEVATED", "WATCH", "NORMAL"))


@query(build(f"SELECT variant, {_CROSS} FROM ver GROUP BY variant", "ver"))
def verdict_crosstab(spark, sf_dir):
    return peers.crosstab(Base(spark, sf_dir).verdicts)


@query(build(f"SELECT variant, {_CROSS}, count(*) AS total FROM ver GROUP BY variant ORDER BY 2 DESC, total DESC, variant LIMIT 8", "ver"))
def variant_breakdown(spark, sf_dir):
    return peers.breakdown(Base(spark, sf_dir).verdicts, 8)


_COUNTS = """SELECT count(*) AS total_validated, count(*) FILTER (WHERE detector_flag) AS detector_flagged, count(*) FILTER (WHERE verdict = 'ELEVATED') AS elevated, count(*) FILTER (WHERE verdict = 'WATCH') AS watch,
  count(*) FILTER (WHERE verdict IN ('ELEVATED', 'WATCH')) AS watchlist_total, count(*) FILTER (WHERE verdict = 'NORMAL') AS normal_after_validation, count(*) FILTER (WHERE spirited) AS spirited_total,
  count(*) FILTER (WHERE spirited AND verdict = 'NORMAL') AS spirited_demoted_to_normal, CAST(0 AS BIGINT) AS no_valid_trips, CAST(sum(n_trips) AS BIGINT) AS valid_trips, count(*) FILTER (WHERE n_trips > 0) AS vehicles_with_valid_trips FROM ver"""


@query(build(_COUNTS, "ver"))
def legacy_summary(spark, sf_dir):
    return peers.summary(Base(spark, sf_dir).verdicts)


def _counts(m: str):
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")


def _with_text_maps(summary: DataFrame) -> DataFrame:
    nested = F.transform(
        F.array_sort(F.map_keys("variant_verdict_counts")), lambda v: F.concat(v, F.lit(":"), _counts(F.col("variant_verdict_counts")[v]))
    )
    return summary.withColumn("variant_verdict_counts", F.array_join(nested, ";")).withColumns({m: _counts(m) for m in ("verdict_counts", "watch_reason_counts")})


@query(O.summary_sql(_COUNTS))
def summary_record(spark, sf_dir):
    """The nested summary, its maps as sorted text."""
    return _with_text_maps(peers.summary_record(staged(Base(spark, sf_dir).verdicts), PROXY))


_OLDER = "s.total_validated AS dashboard_vehicles, s.total_validated AS dashboard_joined_to_validator, CAST(0 AS BIGINT) AS high"


@query(f"SELECT s.* REPLACE (pipeline_version || '-via-adapter' AS pipeline_version), {_OLDER} FROM ({O.summary_sql(_COUNTS)}) s")
def piped_summary(spark, sf_dir):
    """The summary of the older form that counts vehicles without valid trips."""
    return _with_text_maps(forms.summary(staged(Base(spark, sf_dir).verdicts), "piped", PROXY))


@query(f"SELECT s.* REPLACE (total_validated AS vehicles_with_valid_trips), {_OLDER} FROM ({O.summary_sql(_COUNTS, reasons_of='WATCH')}) s")
def listed_summary(spark, sf_dir):
    """The summary of the older form that counts the reasons of WATCH alone."""
    return _with_text_maps(forms.summary(staged(Base(spark, sf_dir).verdicts), "listed", PROXY))


@query(O.explanation_sql("imei, variant, reason AS strong_metrics, '' AS review_recommendation"))
def piped_records(spark, sf_dir):
    """Explained records of the older form with names joined by bars."""
    out = forms.records(Base(spark, sf_dir).verdicts, "piped", PROXY)
    return out.select("imei", "variant", "strong_metrics", "review_recommendation", F.array_join("explanations", " ").alias("explanations"))


@query(build("SELECT imei, variant, verdict, ns AS strong_metric_count, row_number() OVER (ORDER BY CASE verdict WHEN 'ELEVATED' THEN 0 WHEN 'WATCH' THEN 1 ELSE 2 END, ns DESC, variant, imei) AS position FROM ver", "ver"))
def verdict_order(spark, sf_dir):
    return positioned(peers.ordered(Base(spark, sf_dir).verdicts).select("imei", "variant", "verdict", "strong_metric_count"))


@query(build("SELECT imei, variant, verdict FROM ver WHERE verdict = 'WATCH' AND variant = 'A' AND (imei LIKE '%1%' OR lower(variant) LIKE '%1%') ORDER BY ns DESC, imei LIMIT 500", "ver"))
def list_filter(spark, sf_dir):
    return peers.listed(Base(spark, sf_dir).verdicts, "WATCH", "A", "1").select("imei", "variant", "verdict")


@query(build("SELECT imei, variant, ns AS strong_metric_count, row_number() OVER (ORDER BY ns DESC, variant, imei) AS position FROM ver WHERE verdict = 'WATCH'", "ver"))
def batch_targets(spark, sf_dir):
    return positioned(peers.targets(Base(spark, sf_dir).verdicts, "WATCH").select("imei", "variant", "strong_metric_count"))


@query(build("SELECT imei, variant, verdict FROM ver WHERE imei = '7' AND variant = 'A'", "ver"))
def vehicle_lookup(spark, sf_dir):
    return sinks.lookup(Base(spark, sf_dir).verdicts.where("variant = 'A'"), "7").select("imei", "variant", "verdict")


@query(build("SELECT imei, variant, CASE verdict WHEN 'ELEVATED' THEN 'HIGH' WHEN 'WATCH' THEN 'MEDIUM' ELSE 'NORMAL' END AS severity, coalesce(labels2, '') AS strong_metrics, '' AS review_recommendation FROM ver", "ver"))
def legacy_records(spark, sf_dir):
    return peers.legacy(Base(spark, sf_dir).verdicts).select("imei", "variant", "severity", "strong_metrics", "review_recommendation")


@query(build(f"SELECT v.imei, v.variant, t.trip_id, {rnd('t.km_per_soc_pct', 'km_per_soc_pct')}, {rnd('t.dist_km', 'dist_km')} FROM ver v JOIN trips t USING ({V})", "ver", "trips"))
def nested_trips(spark, sf_dir):
    """Trips nested into verdict records, then taken apart again."""
    b = Base(spark, sf_dir)
    return peers.with_trips(b.verdicts, b.trips).select("imei", "variant", F.explode("trips").alias("t")).select("imei", "variant", "t.trip_id", "t.km_per_soc_pct", "t.dist_km")


@query(O.explanation_sql())
def explanations(spark, sf_dir):
    return explain.explanations(Base(spark, sf_dir).verdicts, PROXY).select("imei", "variant", "verdict", F.array_join("explanations", " ").alias("explanations"))


# Fleet reference and comparison


@query(build(f"SELECT variant, duration_bin, soc_consumed_bin, fleet_n, low_confidence, {rows([f'median_{a}' for a in (*ATTRIBUTES, *EVENT_ATTRIBUTES)])}, row_number() OVER (ORDER BY variant, duration_bin, soc_consumed_bin) AS position FROM fleet", "fleet"))
def fleet_reference(spark, sf_dir):
    return positioned(fleet.reference(Base(spark, sf_dir).trips, PROXY))


@query(build(f"SELECT {T}, duration_bin, soc_consumed_bin, fd, fs, far, fleet_n FROM matched", "matched"))
def bucket_lookup(spark, sf_dir):
    return Base(spark, sf_dir).matched.select(*VEHICLE, "trip_id", "duration_bin", "soc_consumed_bin", "fd", "fs", "far", "fleet_n")


@query(build(f"SELECT {T}, attr, {rnd('vehicle')}, {rnd('fleet')}, {rnd('delta')}, {rnd('pct_dev')}, {O.BAND} AS flag FROM attr", "attr"))
def attribute_deviations(spark, sf_dir):
    return fleet.attribute_rows(Base(spark, sf_dir).matched)


@query(build(f"SELECT {T}, det, events, {rnd('max_dwell_s')}, {rnd('fleet_median')}, {O.status('events', 'fleet_median')} AS flag FROM detr", "detr"))
def detector_comparison(spark, sf_dir):
    return fleet.detector_rows(Base(spark, sf_dir).matched)


@query(build(f"SELECT *, {O.status('events_total', 'fleet_total')} AS flag FROM (SELECT {V}, det, CAST(sum(events) AS BIGINT) AS events_total, {rnd('max(max_dwell_s)', 'max_dwell_s')}, {rnd('coalesce(sum(fleet_median), 0.0)', 'fleet_total')}, count(fleet_median) AS fleet_buckets_n, count(*) FILTER (WHERE events > 0) AS trips_fired, row_number() OVER (ORDER BY {V}, sum(events) DESC, det) AS position FROM detr GROUP BY {V}, det)", "detr"))
def detector_rollup(spark, sf_dir):
    return positioned(fleet.detector_rollup(fleet.detector_rows(Base(spark, sf_dir).matched)))


@query(build(f"SELECT {V}, attr, {rnd('avg(pct_dev)', 'mean_dev')} FROM attr GROUP BY {V}, attr", "attr"))
def mean_deviation(spark, sf_dir):
    return fleet.mean_deviation(fleet.attribute_rows(Base(spark, sf_dir).matched))


@query(build(f"SELECT {V}, count(*) AS n_trips, count(*) FILTER (WHERE {O.ELEV}) AS n_elevated FROM trips GROUP BY {V}", "trips"))
def elevated_trips(spark, sf_dir):
    return fleet.elevated_counts(Base(spark, sf_dir).trips)


@query(build(f"SELECT {O.trip_columns()} FROM trips WHERE imei = '7'", "trips"))
def vehicle_trips(spark, sf_dir):
    """One vehicle's trips; its rows are filtered at the scan, thresholds need the whole variant."""
    r = proxy.telemetry(spark, sf_dir)
    return trips.trip_table(r.where("imei = '7'"), staged(detectors.variant_thresholds(r, PROXY)), PROXY)


@query(build(f"SELECT {V}, count(*) AS n_trips, {', '.join(rnd(f'avg({a})', a) for a in SHOWN)} FROM trips GROUP BY {V}", "trips"))
def attribute_means(spark, sf_dir):
    return fleet.attribute_means(Base(spark, sf_dir).trips)


@query(build(f"SELECT {V}, count(*) AS n_trips, {', '.join(rnd(f'avg({a})', a) for a in SHOWN)} FROM trips WHERE mode_1_frac >= mode_0_frac AND NOT {O.ELEV} GROUP BY {V}", "trips"))
def filtered_means(spark, sf_dir):
    return fleet.attribute_means(Base(spark, sf_dir).trips, "thunder", False)


@query(build(f"SELECT CASE WHEN mode_1_frac >= mode_0_frac THEN 'thunder' ELSE 'eco' END AS mode_class, {O.ELEV} AS elevated, count(*) AS n FROM trips GROUP BY 1, 2", "trips"))
def trip_classes(spark, sf_dir):
    return Base(spark, sf_dir).trips.groupBy(mode_class().alias("mode_class"), fleet.is_elevated().alias("elevated")).agg(F.count("*").alias("n"))


@query(build(f"SELECT variant, {', '.join(rnd(f'median(median_{a})', a) for a in SHOWN)} FROM fleet GROUP BY variant", "fleet"))
def fleet_medians(spark, sf_dir):
    return fleet.fleet_medians(Base(spark, sf_dir).fleet)


@query(build(f"SELECT {V}, {rnd('avg(km_per_soc_pct) FILTER (WHERE km_per_soc_pct > 0)', 'all_trips')}, {rnd(f'avg(km_per_soc_pct) FILTER (WHERE km_per_soc_pct > 0 AND {O.ELEV})', 'elevated')}, {rnd(f'avg(km_per_soc_pct) FILTER (WHERE km_per_soc_pct > 0 AND NOT {O.ELEV})', 'others')} FROM trips GROUP BY {V}", "trips"))
def vehicle_range(spark, sf_dir):
    return fleet.vehicle_range(Base(spark, sf_dir).trips)


@query(build(f"SELECT variant, {rnd('median(km_per_soc_pct)', 'fleet_range')} FROM ver JOIN (SELECT {V}, km_per_soc_pct FROM trips WHERE km_per_soc_pct > 0) USING ({V}) GROUP BY variant", "ver", "trips"))
def fleet_range(spark, sf_dir):
    b = Base(spark, sf_dir)
    return fleet.fleet_range(peers.with_trips(b.verdicts, b.trips))


@query(build(f"SELECT {V}, count(*) AS n, {rnd('sum(speed)', 'speed_sum')} FROM tr JOIN (SELECT {T} FROM trips WHERE {O.ELEV}) USING ({T}) GROUP BY {V}", "tr", "trips"))
def elevated_rows(spark, sf_dir):
    b = Base(spark, sf_dir)
    return fleet.elevated_rows(sessions.trips_of(b.held, PROXY, whole=True), b.trips).groupBy(*VEHICLE).agg(F.count("*").alias("n"), F.sum("speed").alias("speed_sum"))


@query(O.share_sql("variant", "mov", "mov"))
def time_in_buckets_fleet(spark, sf_dir):
    return fleet.time_in_buckets(sessions.moving(proxy.telemetry(spark, sf_dir)), ["variant"])


@query(O.share_sql("variant, imei", f"(SELECT tr.* FROM tr JOIN (SELECT {T} FROM trips WHERE {O.ELEV}) USING ({T}))", "tr", "trips"))
def time_in_buckets_elevated(spark, sf_dir):
    b = Base(spark, sf_dir)
    return fleet.time_in_buckets(fleet.elevated_rows(sessions.trips_of(b.held, PROXY, whole=True), b.trips), list(VEHICLE))


@query(O.pair_map_sql())
def pair_maps(spark, sf_dir):
    return fleet.pair_maps(sessions.moving(proxy.telemetry(spark, sf_dir)), ["variant"])


@query(O.inspect_sql())
def inspect(spark, sf_dir):
    """The comparison of every vehicle in one job: attribute and detector rows of each trip, with the verdict."""
    b = Base(spark, sf_dir)
    m, trip = staged(b.matched), [*VEHICLE, "trip_id"]
    none = F.lit(None).cast("double")
    a = fleet.attribute_rows(m).select(*trip, F.lit("attribute").alias("kind"), F.col("attr").alias("name"), F.col("vehicle").alias("value"), "fleet", "pct_dev", none.alias("max_dwell_s"), "flag")
    d = fleet.detector_rows(m).select(*trip, F.lit("detector"), "det", F.col("events").cast("double"), "fleet_median", none, "max_dwell_s", "flag")
    return a.union(d).join(_flat(b.verdicts).select(*VEHICLE, "verdict"), list(VEHICLE), "left")


@query("SELECT CAST(x AS BIGINT) AS x, CAST(round_even(x / 5.0, 0) * 5 AS BIGINT) AS five FROM (SELECT DISTINCT l_quantity / 2 * 5 AS x FROM lineitem WHERE l_quantity % 2 = 0)")
def half_even_bins(spark, sf_dir):
    q = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity % 2 = 0").select((F.col("l_quantity") / 2 * 5).alias("x")).distinct()
    return q.select(F.col("x").cast("long").alias("x"), half_even_bin(F.col("x"), 5.0).alias("five"))


# Distributions and dashboard


@query(O.histogram_sql("variant"))
def fleet_histograms(spark, sf_dir):
    return histograms.histograms(Base(spark, sf_dir).drive, ["variant"])


@query(O.histogram_sql(V))
def vehicle_histograms(spark, sf_dir):
    return histograms.histograms(Base(spark, sf_dir).drive, list(VEHICLE))


@query(O.heatmap_sql("variant"))
def fleet_heatmaps(spark, sf_dir):
    return histograms.heatmaps(Base(spark, sf_dir).drive, ["variant"])


@query(O.heatmap_sql(V))
def vehicle_heatmaps(spark, sf_dir):
    return histograms.heatmaps(Base(spark, sf_dir).drive, list(VEHICLE))


@query(O.stats_sql())
def vehicle_stats(spark, sf_dir):
    return histograms.vehicle_stats(Base(spark, sf_dir).drive)


@query(build(f"SELECT {V}, cluster_id, {rnd('distance_to_center')}, cluster_outlier, {rnd('isolation_score')}, isolation_outlier, is_anomaly, severity, severity_tier, n_records FROM rec", "rec"))
def dashboard_records(spark, sf_dir):
    b = Base(spark, sf_dir)
    return histograms.records(b.flags, b.drive)


_CLUSTERS = """SELECT variant, count(*) AS n_vehicles, CAST(sum(n_records) AS BIGINT) AS n_records, count(DISTINCT cluster_id) AS n_clusters, count(*) FILTER (WHERE cluster_id = 0) || ',' || count(*) FILTER (WHERE cluster_id = 1) AS cluster_sizes,
  """ + rnd("quantile_cont(distance_to_center, 0.9)", "distance_threshold") + """, count(*) FILTER (WHERE is_anomaly) AS n_anomalies, count(*) FILTER (WHERE severity = 'HIGH') AS n_high_severity, count(*) FILTER (WHERE severity = 'MEDIUM') AS n_medium_severity FROM rec GROUP BY variant"""


@query(build(_CLUSTERS, "rec"))
def cluster_summary(spark, sf_dir):
    b = Base(spark, sf_dir)
    return histograms.cluster_summary(histograms.records(b.flags, b.drive)).withColumn("cluster_sizes", F.array_join(F.transform("cluster_sizes", lambda x: x.cast("string")), ","))


@query(build("SELECT count(*) AS total_vehicles, count(*) FILTER (WHERE is_anomaly) AS total_anomalies, count(*) FILTER (WHERE severity = 'HIGH') AS high, count(*) FILTER (WHERE severity = 'MEDIUM') AS medium, count(*) FILTER (WHERE severity = 'NORMAL') AS normal, count(DISTINCT variant) AS n_variants FROM rec", "rec"))
def dashboard_totals(spark, sf_dir):
    b = Base(spark, sf_dir)
    return histograms.totals(histograms.cluster_summary(histograms.records(b.flags, b.drive)))


# Outlier stage


@query(build(f"SELECT {V}, n_records, {rows(FEATURES)} FROM feat", "feat"))
def vehicle_features(spark, sf_dir):
    return ml.vehicle_features(proxy.telemetry(spark, sf_dir), PROXY)


@query(O.standard_sql())
def standardised_features(spark, sf_dir):
    return ml.standardised(ml.vehicle_features(proxy.telemetry(spark, sf_dir), PROXY))


@query(build(f"""SELECT {V}, cluster_id, {rnd('round_even(distance, 4)', 'distance_to_center')}, {rnd('round_even(iso, 4)', 'isolation_score')}, distance >= far AS cluster_outlier, iso > odd AS isolation_outlier, (distance >= far OR iso > odd) AS is_anomaly,
  CAST(distance >= far AS INT) + CAST(iso > odd AS INT) AS severity_tier, CASE CAST(distance >= far AS INT) + CAST(iso > odd AS INT) WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity
  FROM (SELECT {V}, cluster_id, distance_to_center AS distance, isolation_score AS iso FROM flags) JOIN (SELECT variant, quantile_cont(distance_to_center, 0.9) AS far, quantile_cont(isolation_score, 0.9) AS odd FROM flags GROUP BY 1) USING (variant)""", "flags"))
def outlier_marks(spark, sf_dir):
    f = Base(spark, sf_dir).flags
    return ml.mark(f.select(*VEHICLE, "cluster_id", F.col("distance_to_center").alias("distance"), F.col("isolation_score").alias("iso")), PROXY)


@query(build(f"SELECT {V}, is_anomaly, {rnd('isolation_score')}, {rnd('distance_to_center')}, cluster_id, cluster_outlier, isolation_outlier, severity, severity_tier, n_records FROM oflags", "oflags"))
def outlier_flags(spark, sf_dir):
    return ml.outlier_flags(ml.vehicle_features(proxy.telemetry(spark, sf_dir), PROXY), PROXY)


@query(build("SELECT verdict, CASE verdict WHEN 'ELEVATED' THEN 'HIGH' WHEN 'WATCH' THEN 'MEDIUM' ELSE 'NORMAL' END AS severity, count(*) AS n FROM ver GROUP BY 1, 2", "ver"))
def severity_map(spark, sf_dir):
    """Verdicts and the severities they map to, counted."""
    return Base(spark, sf_dir).verdicts.groupBy("verdict", verdict_severity(F.col("verdict")).alias("severity")).agg(F.count("*").alias("n"))


@query(O.explanation_sql("imei, variant, verdict, watch_reason, reason", own_flags=True))
def whole_pipeline(spark, sf_dir):
    """Flags by the own outlier stage, then everything down to explained verdicts."""
    b = Base(spark, sf_dir)
    flags = ml.outlier_flags(ml.vehicle_features(b.rows, PROXY), PROXY)
    return explain.explanations(peers.verdicts(flags, b.profiles, b.trips, PROXY), PROXY).select("imei", "variant", "verdict", "watch_reason", "reason", F.array_join("explanations", " ").alias("explanations"))


@query()
def synthetic_telemetry(spark, sf_dir):
    """Generated telemetry of as many vehicles as there are suppliers."""
    vehicles = spark.read.parquet(f"{sf_dir}/supplier.parquet").count()
    return telemetry.clean(synthetic.build(spark, vehicles)).groupBy(*VEHICLE).agg(F.count("*").alias("n"), F.max("speed").alias("top_speed"))


assert set(DANGER_DETECTORS) <= set(DETECTORS)
