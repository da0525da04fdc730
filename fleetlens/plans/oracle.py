"""The same queries as SQL, built from shared common table expressions."""

from __future__ import annotations

from fleetlens.config import DANGER_DETECTORS, DETECTORS, MATCH_FEATURES, PROXY, SIGNALS
from fleetlens.operators.detectors import RUN_DETECTORS, THRESHOLDS
from fleetlens.operators.explain import REASONS
from fleetlens.operators.fleet import ATTRIBUTES, EVENT_ATTRIBUTES, SHOWN
from fleetlens.operators.histograms import STATS
from fleetlens.operators.ml import FEATURES
from fleetlens.operators.trips import METRICS
from fleetlens.plans import outlier_oracle

# Conditions, edges and bins of the results, written out again, so that a wrong one in an operator shows.
RUN_MASKS = {
    "d1_rpm_speed": "rpm > 50 AND speed > 3 AND rpm / speed > ratio_rpm_speed_p95",
    "d2_throttle_speed": "speed <= speed_p25 AND throttle >= throttle_p75",
    "d3_throttle_current": "current <= current_p25 AND throttle >= throttle_p75",
    "d4_current_torque": "torque <= torque_p25 AND current >= current_p75",
    "d5_current_rpm_torque": "torque <= torque_p50 AND current >= current_p75 AND rpm >= rpm_p75",
    "d6_torque_speed": "speed <= speed_p25 AND torque >= torque_p90",
    "d8_temp_overheat": "current <= current_p25 AND temp >= temp_p90",
}
CHARGE_MASK = "current >= charge_current_p75 AND soc >= 95"
SHARE_EDGES = {"current": (0, 50, 100, 150, 200), "rpm": (0, 1500, 3000, 4500, 6000), "torque": (0, 25, 50, 75, 100), "temp": (0, 25, 40, 55, 70), "throttle": (0, 2, 4, 6, 8), "speed": (0, 15, 30, 45, 60)}
MAP_EDGES = {"current": (0, 50, 100, 150, 200, 250, 300), "rpm": (0, 1000, 2000, 3000, 4000, 5000, 6000, 7000), "torque": (0, 25, 50, 75, 100, 125, 150), "throttle": (0, 2, 4, 6, 8, 10), "speed": (0, 10, 20, 30, 40, 50, 60, 80), "temp": (0, 20, 30, 40, 50, 60, 80)}
MAP_PAIRS = tuple(tuple(p.split(":")) for p in "current:rpm current:torque current:throttle current:speed current:temp rpm:torque rpm:speed torque:speed throttle:speed temp:speed".split())
BINS = {"rpm": (0.0, 7000.0, 28), "torque": (0.0, 200.0, 20), "current": (0.0, 300.0, 20), "speed": (0.0, 80.0, 16), "throttle": (0.0, 10.0, 20), "temp": (0.0, 100.0, 20), "soc": (0.0, 100.0, 20)}
_TEN = {"rpm": (0.0, 7000.0, 10), "torque": (0.0, 200.0, 10), "current": (0.0, 300.0, 10), "speed": (0.0, 80.0, 8), "throttle": (0.0, 10.0, 10), "temp": (0.0, 100.0, 10)}
PAIRS = tuple((x, _TEN[x], y, _TEN[y]) for x, y in (p.split(":") for p in "speed:rpm speed:throttle speed:current current:torque temp:current".split()))

V = "variant, imei"
T = "variant, imei, trip_id"


SHIFT = 3.14159265e-8


def rnd(x: str, name: str | None = None) -> str:
    """A double to 6 places, shifted off the halves on both sides."""
    return f"round({x} + {SHIFT}, 6) + 0.0 AS {name or x}"


def rows(names) -> str:
    return ", ".join(rnd(n) for n in names)


def q(c: str, p: float) -> str:
    return f"quantile_cont({c}, {p})"


def days(a: str, b: str) -> str:
    return f"(epoch_us({a}) - epoch_us({b})) / 1e6 / 86400"


def first(c: str) -> str:
    return f"arg_min({c}, seq) FILTER (WHERE {c} IS NOT NULL)"


def last(c: str) -> str:
    return f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL)"


def _mask_rows(source: str, unit: str, masks: dict[str, str]) -> str:
    parts = [f"SELECT {unit}, place, '{d}' AS det FROM placed WHERE {m}" for d, m in masks.items()]
    return f"""(WITH placed AS (SELECT *, row_number() OVER (PARTITION BY {unit} ORDER BY time, seq) AS place FROM {source}),
      hit AS ({" UNION ALL ".join(parts)}),
      isl AS (SELECT *, place - row_number() OVER (PARTITION BY {unit}, det ORDER BY place) AS island FROM hit),
      run AS (SELECT {unit}, det, island, count(*) AS run FROM isl GROUP BY ALL HAVING count(*) >= 2)
      SELECT {unit}, det, count(*) AS events, max(run) * 5.0 AS max_dwell_s, avg(run) * 5.0 AS mean_dwell_s FROM run GROUP BY ALL)"""


def _robust(source: str, keys: str) -> str:
    """Median and scale of ``value`` by ``keys``."""
    k = keys
    return f"""(WITH f AS (SELECT {k}, median(value) AS med, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, stddev_pop(value) AS sd FROM {source} WHERE value IS NOT NULL GROUP BY {k}),
      d AS (SELECT {k}, median(abs(s.value - f.med)) * 1.4826 AS mad FROM {source} s JOIN f USING ({k}) WHERE s.value IS NOT NULL GROUP BY {k})
      SELECT {k}, med, greatest(CASE WHEN mad > 0 THEN mad WHEN q3 - q1 > 0 THEN (q3 - q1) / 1.349 WHEN sd > 0 THEN sd ELSE 1.0 END, 1e-9) AS scale FROM f JOIN d USING ({k}))"""


def _edge_bin(c: str, low: float, high: float, bins: int) -> str:
    return f"CASE WHEN {c} >= {low} AND {c} < {high} THEN least(CAST(floor(({c} - {low}) / {(high - low) / bins}) AS INT), {bins - 1}) WHEN {c} = {high} THEN {bins - 1} END"


def _uneven(c: str, edges: list[float]) -> str:
    out = f"CASE WHEN {c} IS NULL OR {c} < {edges[0]} THEN NULL"
    for i, top in enumerate(edges[1:]):
        out += f" WHEN {c} {'<=' if i + 2 == len(edges) else '<'} {top} THEN {i}"
    return out + " END"


ELEV = "(" + " OR ".join(f"{d}_events > 0" for d in DANGER_DETECTORS) + ")"
_p = PROXY

CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "tele0": ((), """SELECT l_returnflag AS variant, CAST(l_suppkey AS VARCHAR) AS imei, l_shipdate AS time, row_number() OVER w AS seq,
        sum(l_quantity) OVER (PARTITION BY l_returnflag, l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity ROWS UNBOUNDED PRECEDING) * 0.5 AS odometer,
        l_extendedprice / 10 AS rpm, l_discount * 1000 AS torque, l_quantity AS speed, l_tax * 1000 AS throttle, l_extendedprice / 200 AS current,
        CAST(20 + l_partkey % 61 AS DOUBLE) AS temp, CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END AS state, CAST(l_partkey % 3 AS INT) AS mode
        FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity)"""),
    "tele": (("tele0",), "SELECT *, CAST(100 - seq % 90 AS DOUBLE) AS soc FROM tele0"),
    "src": (("tele",), f"SELECT t.* FROM tele t JOIN (SELECT variant, count(*) FILTER (WHERE state = 2) AS drives FROM tele GROUP BY 1) c USING (variant) WHERE state = 2 OR drives < {_p.min_drive_rows}"),
    "stats": (("tele", "src"), f"""SELECT a.*, b.ratio_rpm_speed_p95, c.charge_current_p75 FROM
        (SELECT variant, {", ".join(f"{q(s, p / 100)} AS {s}_p{p}" for s in ("rpm", "torque", "current", "throttle") for p in (25, 50, 75, 90))}, {q("speed", 0.25)} AS speed_p25, {q("temp", 0.9)} AS temp_p90 FROM src GROUP BY variant) a
        LEFT JOIN (SELECT variant, {q("rpm / speed", 0.95)} AS ratio_rpm_speed_p95 FROM src WHERE speed > 3 AND rpm > 50 GROUP BY variant) b USING (variant)
        LEFT JOIN (SELECT variant, CASE WHEN count(*) >= {_p.min_charge_rows} THEN {q("current", 0.75)} END AS charge_current_p75 FROM tele WHERE state = 1 GROUP BY variant) c USING (variant)"""),
    "mov": (("tele",), f"SELECT *, {days('time', 'lag(time) OVER v')} AS gap FROM tele WHERE state = 2 AND speed > 0 WINDOW v AS (PARTITION BY {V} ORDER BY time, seq)"),
    "tr": (("mov",), f"SELECT *, CAST(sum(CASE WHEN gap > {_p.trip_gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {V} ORDER BY time, seq ROWS UNBOUNDED PRECEDING) AS INT) AS trip_id FROM mov"),
    "chg": (("tele",), f"SELECT *, {days('time', 'lag(time) OVER v')} AS gap FROM tele WHERE state = 1 WINDOW v AS (PARTITION BY {V} ORDER BY time, seq)"),
    "ses": (("chg",), f"SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap > {_p.trip_gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {V} ORDER BY time, seq ROWS UNBOUNDED PRECEDING) AS INT) AS session_id FROM chg"),
    "trs": (("tr", "stats"), "SELECT * FROM tr LEFT JOIN stats USING (variant)"),
    "sess": (("ses", "stats"), "SELECT * FROM ses LEFT JOIN stats USING (variant)"),
    "ev": (("trs",), f"SELECT * FROM {_mask_rows('trs', T, RUN_MASKS)}"),
    "ev7": (("sess",), f"SELECT * FROM {_mask_rows('sess', V + ', session_id', {'d7_charge_overtaper': CHARGE_MASK})}"),
    "raw": (("tr",), f"""SELECT {T}, count(*) AS n_rows, round_even(coalesce(sum(gap) FILTER (WHERE gap <= {_p.max_sample_gap}), 0.0) / {_p.units_per_minute}, 4) AS duration_min, count(odometer) AS n_odo,
        {last("odometer")} - {first("odometer")} AS dist_km, avg(speed) AS mean_speed, avg(speed) AS avg_speed, {", ".join(f"{q(c, 0.9)} AS p90_{c}" for c in ("speed", "rpm", "torque", "throttle", "current"))},
        {", ".join(f"{q(c, 0.5)} AS median_{c}" for c in ("rpm", "torque", "throttle", "current", "temp"))}, count(*) FILTER (WHERE speed < 10) / count(*) AS low_speed_frac,
        count(*) FILTER (WHERE current > 150) / count(*) AS current_spike_rate, count(*) FILTER (WHERE temp > 50) / count(*) AS high_temp_rate, {first("soc")} AS soc_start, {last("soc")} AS soc_end,
        max(temp) AS peak_temp, CASE WHEN count(temp) >= 2 THEN max(temp) - min(temp) END AS temp_delta_c,
        coalesce(count(*) FILTER (WHERE mode = 0) / nullif(count(*) FILTER (WHERE mode IN (0, 1)), 0), 0.0) AS mode_0_frac, coalesce(count(*) FILTER (WHERE mode = 1) / nullif(count(*) FILTER (WHERE mode IN (0, 1)), 0), 0.0) AS mode_1_frac
        FROM tr GROUP BY {T}"""),
    "met": (("raw",), """SELECT *, soc_start - soc_end AS soc_consumed, CASE WHEN soc_start - soc_end > 0 THEN dist_km / (soc_start - soc_end) END AS km_per_soc_pct,
        CASE WHEN mean_speed > 0 THEN median_current / mean_speed END AS current_per_speed, CASE WHEN median_torque > 0 THEN median_current / median_torque END AS current_per_torque FROM raw"""),
    "okt": (("met",), f"SELECT * FROM met WHERE n_rows >= 2 AND duration_min >= {_p.min_minutes} AND n_odo >= 2 AND dist_km >= {_p.min_km} AND coalesce(km_per_soc_pct <= {_p.max_km_per_soc}, true)"),
    "trips": (("okt", "ev"), f"""SELECT o.*, {", ".join(f"coalesce(e.{d}_events, 0) AS {d}_events, coalesce(e.{d}_max_dwell_s, 0.0) AS {d}_max_dwell_s" for d in RUN_DETECTORS)}, CAST(0 AS BIGINT) AS d7_charge_overtaper_events, 0.0 AS d7_charge_overtaper_max_dwell_s
        FROM okt o LEFT JOIN (SELECT {T}, {", ".join(f"max(events) FILTER (WHERE det = '{d}') AS {d}_events, max(max_dwell_s) FILTER (WHERE det = '{d}') AS {d}_max_dwell_s" for d in RUN_DETECTORS)} FROM ev GROUP BY {T}) e USING ({T})"""),
    "charges": (("tele", "ses", "ev7"), f"""SELECT {V}, coalesce(d7_events, 0) AS d7_events, coalesce(d7_max_dwell_s, 0.0) AS d7_max_dwell_s, coalesce(charge_hours, 0.0) AS charge_hours FROM (SELECT DISTINCT {V} FROM tele)
        LEFT JOIN (SELECT {V}, sum(span) / 60 AS charge_hours, CAST(sum(coalesce(events, 0)) AS BIGINT) AS d7_events, max(max_dwell_s) AS d7_max_dwell_s
          FROM (SELECT {V}, session_id, {days("max(time)", "min(time)")} AS span FROM ses GROUP BY ALL HAVING count(*) >= {_p.min_session_rows}) LEFT JOIN ev7 USING ({V}, session_id) GROUP BY {V}) USING ({V})"""),
    "prof": (("trips", "charges"), f"""SELECT *, {", ".join(f"CASE WHEN {h} > 0 THEN {d}_events_total / {h} ELSE 0.0 END AS {d}_rate" for d in DETECTORS for h in ["charge_hours" if d.startswith("d7") else "drive_hours"])}
        FROM (SELECT t.*, coalesce(d7_events, 0) AS d7_charge_overtaper_events_total, coalesce(d7_max_dwell_s, 0.0) AS d7_charge_overtaper_max_dwell_s, coalesce(charge_hours, 0.0) AS charge_hours FROM
          (SELECT {V}, count(*) AS n_trips, {", ".join(f"median({f}) AS {f}" for f in MATCH_FEATURES)}, sum(duration_min) / 60 AS drive_hours,
            {", ".join(f"CAST(sum({d}_events) AS BIGINT) AS {d}_events_total, max({d}_max_dwell_s) AS {d}_max_dwell_s" for d in RUN_DETECTORS)} FROM trips GROUP BY {V}) t LEFT JOIN charges USING ({V}))"""),
    "plong": (("prof",), " UNION ALL ".join(f"SELECT variant, imei, '{f}' AS feature, {f} AS value FROM prof" for f in MATCH_FEATURES)),
    "pscale": (("plong",), f"SELECT * FROM {_robust('plong', 'variant, feature')}"),
    "pz": (("plong", "pscale"), "SELECT variant, imei, feature, coalesce((value - med) / scale, 0.0) AS z FROM plong LEFT JOIN pscale USING (variant, feature)"),
    "dist": (("pz",), "SELECT a.variant, a.imei, b.imei AS peer, round(sqrt(sum((a.z - b.z) * (a.z - b.z))), 9) AS distance FROM pz a JOIN pz b ON a.variant = b.variant AND a.feature = b.feature AND a.imei <> b.imei GROUP BY ALL"),
    "peers": (("dist", "prof"), f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {V} ORDER BY distance, peer) AS INT) AS rank FROM dist) WHERE rank <= {_p.peers} AND variant IN (SELECT variant FROM prof GROUP BY 1 HAVING count(*) > {_p.min_peers})"),
    "rates": (("prof",), " UNION ALL ".join(f"SELECT variant, imei, '{d}' AS det, {d}_rate AS rate FROM prof" for d in DETECTORS)),
    "prate": (("peers", "rates"), "SELECT p.variant, p.imei, r.det, r.rate AS value FROM peers p JOIN rates r ON r.variant = p.variant AND r.imei = p.peer"),
    "score": (("prate", "rates"), f"""SELECT {V}, det, rate, (rate - med) / scale AS z, peer_p95 FROM rates JOIN {_robust("prate", V + ", det")} s USING ({V}, det)
        JOIN (SELECT {V}, det, {q("value", 0.95)} AS peer_p95 FROM prate GROUP BY {V}, det) USING ({V}, det)"""),
    "veh": (("tele",), f"SELECT {V}, count(*) FILTER (WHERE state = 2) AS n_records FROM tele GROUP BY {V}"),
    "flags": (("veh",), f"""SELECT *, cluster_outlier OR isolation_outlier AS is_anomaly, CAST(cluster_outlier AS INT) + CAST(isolation_outlier AS INT) AS severity_tier,
        CASE CAST(cluster_outlier AS INT) + CAST(isolation_outlier AS INT) WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity
        FROM (SELECT {V}, n_records, s_acctbal < 2000 AS cluster_outlier, s_acctbal < 500 AS isolation_outlier, s_acctbal / 100 AS isolation_score, abs(s_acctbal) / 100 AS distance_to_center, CAST(s_nationkey % 2 AS INT) AS cluster_id
          FROM veh JOIN supplier ON imei = CAST(s_suppkey AS VARCHAR))"""),
    "strong": (("score", "flags"), f"""SELECT {V}, det, rate, z, peer_p95, is_anomaly, (bz OR br) AS strong, CASE WHEN bz THEN 'z' WHEN br THEN 'rate_p95' ELSE '' END AS strong_reason FROM
        (SELECT *, round(z, 9) >= CASE WHEN is_anomaly THEN {_p.z_flagged} ELSE {_p.z_unflagged} END AS bz, rate > 0 AND rate >= peer_p95 AS br FROM score JOIN (SELECT {V}, is_anomaly FROM flags) USING ({V}))"""),
    "spir": (("trips",), f"""SELECT *, coalesce(fast_share >= {_p.spirited_share} AND median_p90 >= {_p.spirited_p90}, false) AS spirited FROM
        (SELECT {V}, avg(CASE WHEN mean_speed > {_p.spirited_mean} THEN 1.0 ELSE 0.0 END) AS fast_share, median(p90_speed) AS median_p90 FROM trips GROUP BY {V})"""),
    "ver0": (("flags", "prof", "peers", "strong", "spir"), f"""SELECT p.*, f.is_anomaly AS detector_flag, f.isolation_score, f.cluster_id, coalesce(n.n_peers, 0) AS n_peers, coalesce(s.ns, 0) AS ns, coalesce(s.reason, '') AS reason, s.ids, s.labels2, spirited
        FROM flags f JOIN prof p USING ({V}) LEFT JOIN (SELECT {V}, count(*) AS n_peers FROM peers GROUP BY {V}) n USING ({V})
        LEFT JOIN (SELECT {V}, CAST(count(*) AS INT) AS ns, string_agg(label, ' | ' ORDER BY det) AS reason, string_agg(label, '; ' ORDER BY det) AS labels2, string_agg(det || '_rate', ',' ORDER BY det) AS ids
          FROM strong JOIN (VALUES {", ".join(f"('{d}', '{t}')" for d, t in DETECTORS.items())}) l(det, label) USING (det) WHERE strong GROUP BY {V}) s USING ({V})
        LEFT JOIN spir USING ({V})"""),
    "ver": (("ver0",), f"""SELECT *, CASE WHEN n_peers < {_p.min_peers} AND spirited THEN 'NORMAL' WHEN n_peers < {_p.min_peers} AND detector_flag THEN 'WATCH' WHEN n_peers < {_p.min_peers} THEN 'NORMAL'
          WHEN spirited AND ns <= {_p.spirited_max_strong} THEN 'NORMAL' WHEN detector_flag AND ns >= {_p.strong_with_flag} THEN 'ELEVATED' WHEN NOT detector_flag AND ns = 0 THEN 'NORMAL' ELSE 'WATCH' END AS verdict,
        CASE WHEN n_peers < {_p.min_peers} AND spirited THEN 'SPIRITED_DRIVER_HIGH_SPEED_HIGH_RPM' WHEN n_peers < {_p.min_peers} THEN 'INSUFFICIENT_PEERS' WHEN spirited AND ns <= {_p.spirited_max_strong} THEN 'SPIRITED_DRIVER_HIGH_SPEED_HIGH_RPM'
          WHEN detector_flag AND ns >= {_p.strong_with_flag} THEN 'ML_AND_DUAL' WHEN NOT detector_flag AND ns = 0 THEN 'NO_ML_NO_DUAL' WHEN detector_flag AND ns = 0 THEN 'ML_ONLY_PATTERN' WHEN detector_flag AND ns = 1 THEN 'ML_PLUS_ONE_DUAL' ELSE 'PHYSICS_ONLY_NO_ML' END AS watch_reason FROM ver0"""),
    "bins": (("trips",), f"SELECT *, CAST(round_even(duration_min / {_p.minutes_bin}, 0) * {_p.minutes_bin} AS BIGINT) AS duration_bin, CAST(round_even(soc_consumed / {_p.soc_bin}, 0) * {_p.soc_bin} AS BIGINT) AS soc_consumed_bin FROM trips"),
    "fleet": (("bins",), f"""SELECT variant, duration_bin, soc_consumed_bin, count(*) AS fleet_n, count(*) < {_p.low_confidence} AS low_confidence, {", ".join(f"median({a}) AS median_{a}" for a in (*ATTRIBUTES, *EVENT_ATTRIBUTES))}
        FROM bins WHERE duration_bin IS NOT NULL AND soc_consumed_bin IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= {_p.min_bucket}"""),
    "near": (("bins", "fleet"), """SELECT * FROM (SELECT c.*, f.duration_bin AS fd, f.soc_consumed_bin AS fs, abs(c.duration_bin - f.duration_bin) + abs(c.soc_consumed_bin - f.soc_consumed_bin) AS far,
          row_number() OVER (PARTITION BY c.variant, c.duration_bin, c.soc_consumed_bin ORDER BY abs(c.duration_bin - f.duration_bin) + abs(c.soc_consumed_bin - f.soc_consumed_bin), f.duration_bin, f.soc_consumed_bin) AS k
          FROM (SELECT DISTINCT variant, duration_bin, soc_consumed_bin FROM bins) c JOIN fleet f USING (variant)) WHERE k = 1"""),
    "matched": (("bins", "near", "fleet"), f"""SELECT b.*, n.fd, n.fs, n.far, f.fleet_n, f.low_confidence, {", ".join(f"f.median_{a} AS fleet_{a}" for a in (*ATTRIBUTES, *EVENT_ATTRIBUTES))} FROM bins b LEFT JOIN near n USING (variant, duration_bin, soc_consumed_bin)
        LEFT JOIN fleet f ON f.variant = b.variant AND f.duration_bin = n.fd AND f.soc_consumed_bin = n.fs"""),
    "attr": (("matched",), f"""SELECT {T}, attr, vehicle, fleet, vehicle - fleet AS delta, CASE WHEN fleet <> 0 THEN (vehicle - fleet) / fleet * 100 END AS pct_dev, fd FROM ({" UNION ALL ".join(f"SELECT {T}, '{a}' AS attr, {a} AS vehicle, fleet_{a} AS fleet, fd FROM matched" for a in SHOWN)}) WHERE vehicle IS NOT NULL"""),
    "detr": (("matched",), " UNION ALL ".join(f"SELECT {T}, '{d}' AS det, {d}_events AS events, {d}_max_dwell_s AS max_dwell_s, fleet_{d}_events AS fleet_median FROM matched" for d in DANGER_DETECTORS)),
    "drv": (("tele",), "SELECT * FROM tele WHERE state = 2 OR (SELECT count(*) FROM tele WHERE state = 2) = 0"),
    "feat": (("tele",), f"SELECT {V}, count(*) AS n_records, {', '.join(f'{q(s, 0.5)} AS {s}_p50, {q(s, 0.9)} AS {s}_p90, {q(s, 0.75)} - {q(s, 0.25)} AS {s}_iqr' for s in SIGNALS)} FROM tele WHERE state = 2 GROUP BY {V} HAVING count(*) >= {_p.min_feature_rows}"),
    "rec": (("flags", "drv"), f"SELECT {V}, cluster_id, distance_to_center, cluster_outlier, isolation_score, isolation_outlier, is_anomaly, severity, severity_tier, coalesce(r.n, n_records) AS n_records FROM flags LEFT JOIN (SELECT {V}, count(*) AS n FROM drv GROUP BY {V}) r USING ({V})"),
}


CTE |= outlier_oracle.steps()


def build(final: str, *needs: str, own_flags: bool = False) -> str:
    """``final`` with all common table expressions it needs, in order; ``own_flags``: flags come from the outlier stage."""
    tables = CTE | {"flags": (("oflags",), "SELECT * FROM oflags")} if own_flags else CTE
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in tables[name][0]:
                add(n)
            order.append(name)

    for n in needs:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({tables[n][1]})" for n in order) + "\n" + final if order else final


BAND = "CASE WHEN fd IS NULL THEN 'no-bucket' WHEN pct_dev IS NULL THEN 'n/a' WHEN abs(pct_dev) < 15 THEN 'ok' WHEN abs(pct_dev) < 30 THEN 'warn' ELSE 'alert' END"


def status(e: str, f: str) -> str:
    return f"CASE WHEN {e} <= 0 THEN 'ok' WHEN {f} IS NULL OR {f} <= 0 THEN 'alert' WHEN {e} > 2 * {f} THEN 'alert' ELSE 'warn' END"


def trip_columns() -> str:
    return f"{T}, {rows(METRICS)}, " + ", ".join(f"{d}_events, {rnd(f'{d}_max_dwell_s')}" for d in DETECTORS)


def verdict_columns() -> str:
    per = ", ".join(f"{d}_events_total, {rnd(f'round_even({d}_max_dwell_s, 2)', f'{d}_max_dwell_s')}, {rnd(f'round_even({d}_rate, 4)', f'{d}_rate')}" for d in DETECTORS)
    return (
        f"{V}, detector_flag, {rnd('isolation_score')}, cluster_id, verdict, watch_reason, reason, n_trips, n_peers, {rnd('round_even(drive_hours, 3)', 'drive_hours')}, {rnd('round_even(charge_hours, 3)', 'charge_hours')}, "
        f"ns AS strong_metric_count, coalesce(ids, '') AS strong_metric_ids, spirited, {rnd('round_even(mode_0_frac, 4)', 'mode_0_frac')}, {rnd('round_even(mode_1_frac, 4)', 'mode_1_frac')}, {per}"
    )


def explanation_sql(columns: str = "imei, variant, verdict", own_flags: bool = False) -> str:
    """Headline, sentences of strong detectors in order, notes and caveats, joined by a space."""
    facts = " UNION ALL ".join(f"SELECT {V}, '{d}' AS det, {d}_events_total AS n, round_even({d}_max_dwell_s, 2) AS dwell FROM prof" for d in DETECTORS)
    labels = ", ".join(f"('{d}', '{t}')" for d, t in DETECTORS.items())
    z, rate = "round_even(z, 3)", "round_even(rate, 4)"
    strength = f"CASE WHEN abs({z}) >= 4 THEN 'far beyond its peers' WHEN abs({z}) >= 3 THEN 'well beyond its peers' WHEN abs({z}) >= 2 THEN 'clearly beyond its peers' ELSE 'above its peers' END"
    sentence = f"""label || ': ' || concat_ws(', ', CASE WHEN n > 0 THEN n || ' event(s)' END, CASE WHEN dwell > 0 THEN 'longest ' || printf('%.0f', round_even(dwell, 0)) || ' s' END,
        CASE WHEN z IS NOT NULL THEN {strength} || ' (z ' || printf('%.1f', round_even({z}, 1)) || ')' WHEN rate > 0 THEN printf('%.2f', round_even({rate}, 2)) || ' per hour' END) || '.'"""
    why = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in REASONS.items())
    return build(
        f"""SELECT {columns}, concat_ws(' ',
        CASE WHEN verdict = 'ELEVATED' THEN 'Elevated: an unusual usage pattern together with ' || ns || ' strong signal contradictions.'
          WHEN verdict = 'WATCH' THEN 'Watch: ' || CASE watch_reason {why} ELSE '{REASONS["PARTIAL_EVIDENCE"]}' END || '.'
          WHEN spirited THEN 'Normal: driven fast, with ' || ns || ' strong contradiction(s), too few to count against it.' ELSE 'Normal: it behaves like the vehicles it is compared with.' END,
        sentences, CASE WHEN spirited AND verdict = 'ELEVATED' THEN 'It is also driven fast; repeated contradictions outweigh driving style.' END,
        CASE WHEN n_peers > 0 AND n_peers < {_p.min_peers} AND verdict <> 'NORMAL' THEN 'Caution: only ' || n_peers || ' comparable vehicles.' END,
        CASE WHEN n_trips <= 2 AND verdict IN ('ELEVATED', 'WATCH') THEN 'Caution: based on ' || n_trips || ' trip(s).' END) AS explanations
        FROM ver LEFT JOIN (SELECT {V}, string_agg({sentence}, ' ' ORDER BY det) AS sentences FROM strong JOIN ({facts}) USING ({V}, det) JOIN (VALUES {labels}) l(det, label) USING (det) WHERE strong GROUP BY {V}) USING ({V})""",
        "ver", "strong", "prof", own_flags=own_flags,
    )


def summary_sql(counts: str, reasons_of: str | None = None) -> str:
    """The flat counts, and counts by verdict, reason (of one verdict, if given) and variant as sorted text."""
    listed = lambda key, where="": f"(SELECT string_agg({key} || '=' || n, ',' ORDER BY {key}) FROM (SELECT {key}, count(*) AS n FROM ver{where} GROUP BY 1))"
    only = f" WHERE verdict = '{reasons_of}'" if reasons_of else ""
    return build(
        f"""SELECT s.*, {listed("verdict")} AS verdict_counts, {listed("watch_reason", only)} AS watch_reason_counts,
        (SELECT string_agg(variant || ':' || v, ';' ORDER BY variant) FROM (SELECT variant, string_agg(verdict || '=' || n, ',' ORDER BY verdict) AS v FROM (SELECT variant, verdict, count(*) AS n FROM ver GROUP BY 1, 2) GROUP BY 1)) AS variant_verdict_counts,
        '{_p.version}' AS pipeline_version FROM ({counts}) s""",
        "ver",
    )


def inspect_sql() -> str:
    return build(
        f"""SELECT c.*, verdict FROM (SELECT {T}, 'attribute' AS kind, attr AS name, {rnd("vehicle", "value")}, {rnd("fleet")}, {rnd("pct_dev")}, CAST(NULL AS DOUBLE) AS max_dwell_s, {BAND} AS flag FROM attr
        UNION ALL SELECT {T}, 'detector', det, {rnd("CAST(events AS DOUBLE)", "value")}, {rnd("fleet_median", "fleet")}, CAST(NULL AS DOUBLE), {rnd("max_dwell_s")}, {status("events", "fleet_median")} FROM detr) c LEFT JOIN (SELECT {V}, verdict FROM ver) USING ({V})""",
        "attr", "detr", "ver",
    )


def histogram_sql(keys: str, source: str = "drv") -> str:
    parts = [f"SELECT {keys}, '{s}' AS signal, {_edge_bin(s, *b)} AS bin FROM {source}" for s, b in BINS.items()] + [f"SELECT {keys}, 'mode' AS signal, CASE WHEN mode IN (0, 1) THEN mode END AS bin FROM {source}"]
    return build(f"SELECT {keys}, signal, bin, {rnd(f'round_even(n * 100.0 / sum(n) OVER (PARTITION BY {keys}, signal), 3)', 'pct')} FROM (SELECT {keys}, signal, bin, count(*) AS n FROM ({' UNION ALL '.join(parts)}) WHERE bin IS NOT NULL GROUP BY ALL)", source)


def heatmap_sql(keys: str) -> str:
    parts = [f"SELECT {keys}, '{x}_vs_{y}' AS pair, {_edge_bin(x, *xb)} AS x_bin, {_edge_bin(y, *yb)} AS y_bin FROM drv" for x, xb, y, yb in PAIRS]
    return build(f"SELECT {keys}, pair, x_bin, y_bin, {rnd(f'round_even(n * 100.0 / sum(n) OVER (PARTITION BY {keys}, pair), 3)', 'pct')} FROM (SELECT {keys}, pair, x_bin, y_bin, count(*) AS n FROM ({' UNION ALL '.join(parts)}) WHERE x_bin IS NOT NULL AND y_bin IS NOT NULL GROUP BY ALL)", "drv")


def pair_map_sql() -> str:
    parts = [f"SELECT variant, '{x}_vs_{y}' AS pair, {_uneven(y, MAP_EDGES[y])} AS y_bin, {_uneven(x, MAP_EDGES[x])} AS x_bin FROM mov" for x, y in MAP_PAIRS]
    return build(f"SELECT variant, pair, y_bin, x_bin, {rnd('round_even(n * 100.0 / sum(n) OVER (PARTITION BY variant, pair), 6)', 'pct')} FROM (SELECT variant, pair, y_bin, x_bin, count(*) AS n FROM ({' UNION ALL '.join(parts)}) WHERE x_bin IS NOT NULL AND y_bin IS NOT NULL GROUP BY ALL)", "mov")


def share_sql(keys: str, source: str, *needs: str) -> str:
    parts = []
    for s, edges in SHARE_EDGES.items():
        for i, low in enumerate(edges):
            inside = f"{s} >= {low}" + (f" AND {s} < {edges[i + 1]}" if i + 1 < len(edges) else "")
            parts.append(f"SELECT {keys}, '{s}' AS signal, {i} AS bucket, {rnd(f'round_even(coalesce(count(*) FILTER (WHERE {inside}) * 100.0 / nullif(count({s}), 0), 0.0), 2)', 'pct')} FROM {source} GROUP BY {keys}")
    return build(" UNION ALL ".join(parts), *needs)


def stats_sql() -> str:
    parts = [f"SELECT {V}, '{s}' AS signal, CAST({s} AS DOUBLE) AS value FROM drv" + (" WHERE mode IN (0, 1)" if s == "mode" else "") for s in STATS]
    return build(f"SELECT {V}, signal, {rnd('avg(value)', 'mean')}, {rnd(q('value', 0.5), 'p50')}, {rnd(q('value', 0.9), 'p90')} FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL GROUP BY ALL", "drv")


def standard_sql() -> str:
    med = ", ".join(f"median({f}) AS med_{f}" for f in FEATURES)
    fill = ", ".join(f"coalesce({f}, med_{f}, 0.0) AS {f}" for f in FEATURES)
    st = ", ".join(f"avg({f}) AS mean_{f}, stddev_pop({f}) AS sd_{f}" for f in FEATURES)
    z = ", ".join(rnd(f"({f} - mean_{f}) / CASE WHEN sd_{f} > 1e-12 THEN sd_{f} ELSE 1.0 END", f) for f in FEATURES)
    return build(f"SELECT {V}, n_records, cohort, {z} FROM (SELECT {V}, n_records, {fill} FROM feat JOIN (SELECT variant, {med} FROM feat GROUP BY 1) USING (variant)) x JOIN (SELECT variant, count(*) AS cohort, {st} FROM (SELECT variant, {fill} FROM feat JOIN (SELECT variant, {med} FROM feat GROUP BY 1) USING (variant)) GROUP BY 1) USING (variant)", "feat")


ALL_THRESHOLDS = rows(THRESHOLDS)
