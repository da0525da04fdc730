"""Hand-made cases for the rules that are easy to get wrong."""

import datetime as dt
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, DETECTORS, PROXY
from fleetlens.functions.core import detector_status, deviation, deviation_band, edge_bin, half_even_bin, small_integer, uneven_bin, vehicle_id
from fleetlens.operators import detectors, explain, fleet, ml, peers, sessions, trips
from fleetlens.plans.pipeline import Run
from fleetlens.sources import sinks, synthetic, telemetry
from fleetlens.streaming.trips import streaming_trips

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "variant string, imei string, time timestamp, seq long, odometer double, rpm double, torque double, speed double, throttle double, current double, temp double, soc double, state short, mode short"


def rows(spark, items):
    """items: dicts with ``s`` (seconds) and any columns."""
    base = {"variant": "v", "imei": "1", "odometer": 0.0, "rpm": 100.0, "torque": 10.0, "speed": 10.0, "throttle": 1.0, "current": 10.0, "temp": 30.0, "soc": 50.0, "state": 2, "mode": 0}
    out = []
    for n, x in enumerate(items):
        r = base | {"time": T0 + dt.timedelta(seconds=x["s"]), "seq": n} | {k: v for k, v in x.items() if k != "s"}
        out.append(tuple(r[c.split()[0]] for c in SCHEMA.split(", ")))
    return spark.createDataFrame(out, SCHEMA)


def test_gap_is_strict_and_ids_start_at_0_and_1(spark):
    r = rows(spark, [{"s": s} for s in (0, 900, 1801)] + [{"s": s, "state": 1} for s in (5000, 5900, 6801)])
    assert [x.trip_id for x in sessions.trips_of(r).orderBy("time").collect()] == [0, 0, 1]
    assert [x.session_id for x in sessions.charge_sessions_of(r).orderBy("time").collect()] == [1, 1, 2]


def plain_runs(mask, dwell):
    runs, n = [], 0
    for m in [*mask, False]:
        if m:
            n += 1
        elif n:
            runs.append(n)
            n = 0
    return [x for x in runs if x >= dwell]


def test_dwell_runs_equal_plain_python(spark):
    rng = random.Random(1)
    data = {(u, d): [rng.random() < 0.6 for _ in range(40)] for u in range(15) for d in ("a", "b")}
    frame = spark.createDataFrame([(u, d, i, m) for (u, d), ms in data.items() for i, m in enumerate(ms)], "u int, det string, place int, hit boolean").repartition(5)
    got = {(r.u, r.det): (r.events, r.max_dwell_s) for r in sessions.dwell_runs(frame, ["u"], {"a": 3, "b": 5}, 5.0).collect()}
    want = {k: (len(x), 5.0 * max(x)) for k, ms in data.items() if (x := plain_runs(ms, {"a": 3, "b": 5}[k[1]]))}
    assert got == want


def test_dwell_edges_and_removed_rows(spark):
    limits = spark.createDataFrame([("v", 5.0, 2.0)], "variant string, throttle_p75 double, speed_p25 double").select("*", *[F.lit(None).cast("double").alias(t) for t in detectors.THRESHOLDS if t not in ("throttle_p75", "speed_p25")])
    hit, miss, still = {"throttle": 6.0, "speed": 1.0}, {"throttle": 1.0, "speed": 1.0}, {"throttle": 6.0, "speed": 0.0}
    seq = [hit] * 3 + [miss] + [hit] * 4 + [miss] + [hit] * 5 + [miss] + [hit] * 2 + [still] + [hit] * 2
    r = rows(spark, [x | {"s": 5 * i} for i, x in enumerate(seq)])
    got = detectors.trip_events(sessions.trips_of(r), limits, DEFAULT, ["d2_throttle_speed"]).collect()
    assert [(x.events, x.max_dwell_s) for x in got] == [(3, 25.0)]
    far = rows(spark, [hit | {"s": 0}, hit | {"s": 800}])
    one = detectors.trip_events(sessions.trips_of(far), limits, replace(DEFAULT, dwell=dict.fromkeys(DETECTORS, 2)), ["d2_throttle_speed"]).collect()
    assert [x.events for x in one] == [1]


def test_ratio_threshold_is_strict(spark):
    limits = spark.createDataFrame([("v", 10.0)], "variant string, ratio_rpm_speed_p95 double").select("*", *[F.lit(None).cast("double").alias(t) for t in detectors.THRESHOLDS if t != "ratio_rpm_speed_p95"])
    r = rows(spark, [{"s": 5 * i, "rpm": 100.0, "speed": 10.0} for i in range(5)])
    assert detectors.trip_events(sessions.trips_of(r), limits).count() == 0


def test_overtaper_needs_a_session_of_four(spark):
    limits = spark.createDataFrame([("v", 20.0)], "variant string, charge_current_p75 double").select("*", *[F.lit(None).cast("double").alias(t) for t in detectors.THRESHOLDS if t != "charge_current_p75"])
    for n, want in ((4, (1, 20.0)), (3, (0, 0.0))):
        r = rows(spark, [{"s": 60 * i, "state": 1, "soc": 96.0, "current": 20.0} for i in range(n)])
        x = trips.charge_summary(r, limits).collect()[0]
        assert (x.d7_events, x.d7_max_dwell_s) == want and x.charge_hours == (0.05 if n == 4 else 0)


def test_trip_gates(spark):
    drive = lambda km, soc, imei, n=80: [{"s": 5 * i, "imei": imei, "odometer": km * i / (n - 1), "soc": soc(i)} for i in range(n)]
    items = drive(3.0, lambda i: 50 - i * 0.05, "ok") + drive(1.9, lambda i: 50 - i * 0.05, "near") + drive(3.0, lambda i: None, "unknown") + drive(90.0, lambda i: 50 - i * 0.05, "leap") + drive(-5.0, lambda i: 50.0, "rollover") + drive(3.0, lambda i: 50.0, "short", 20)
    t = trips.trip_table(rows(spark, items), detectors.variant_thresholds(rows(spark, items))).collect()
    assert {r.imei for r in t} == {"ok", "unknown"}
    unknown = next(r for r in t if r.imei == "unknown")
    assert unknown.soc_consumed is None and unknown.km_per_soc_pct is None
    frame = spark.createDataFrame([(12.5, None), (7.5, 3.0)], "duration_min double, soc_consumed double")
    assert [(r.duration_bin, r.soc_consumed_bin) for r in fleet.with_bins(frame).collect()] == [(10, None), (10, 4)]


def test_mode_shares_are_quotients(spark):
    r = rows(spark, [{"s": i * 60, "mode": m} for i, m in enumerate((0, 0, 1, None, 2))])
    got = trips.raw_trip_metrics(sessions.trips_of(r)).select("mode_0_frac", "mode_1_frac").collect()
    assert [tuple(x) for x in got] == [(2 / 3, 1 / 3)]  # 1 - 2 / 3 is not 1 / 3


def test_ids_and_numbers(spark):
    ids = ["860000000000000", "860000000000000.0", "8.6E14", "nan", " ", "<NA>", None, "AB12", " 7 "]
    frame = spark.createDataFrame([(i,) for i in ids], "x string")
    assert [r[0] for r in frame.select(vehicle_id(F.col("x"))).collect()] == ["860000000000000"] * 3 + [None] * 4 + ["AB12", "7"]
    frame = spark.createDataFrame([(i,) for i in ("2", "1.0", "1.5", "x", "NaN", "inf", None)], "x string")
    assert [r[0] for r in frame.select(small_integer(F.col("x"))).collect()] == [2, 1, None, None, None, None, None]


def test_bins(spark):
    frame = spark.createDataFrame([(x,) for x in (0.0, 4.99, 5.0, 80.0, 80.01, -0.1, None)], "x double")
    assert [r[0] for r in frame.select(edge_bin(F.col("x"), 0.0, 80.0, 16)).collect()] == [0, 0, 1, 15, None, None, None]
    assert [r[0] for r in frame.select(uneven_bin(F.col("x"), [0, 5, 80])).collect()] == [0, 0, 1, 1, None, None, None]
    assert [r[0] for r in frame.limit(3).select(half_even_bin(F.col("x") + 2.5, 5.0)).collect()] == [0, 5, 10]


def test_bands(spark):
    f = spark.createDataFrame([(110.0, 100.0), (120.0, 100.0), (50.0, 100.0), (5.0, 0.0), (5.0, None)], "v double, f double")
    assert [r[0] for r in f.select(deviation_band(deviation(F.col("v"), F.col("f")), F.lit(True))).collect()] == ["ok", "warn", "alert", "n/a", "n/a"]
    assert f.limit(1).select(deviation_band(F.lit(None).cast("double"), F.lit(False))).collect()[0][0] == "no-bucket"
    e = spark.createDataFrame([(0, 1.0), (3, None), (3, 0.0), (3, 1.0), (2, 1.0)], "e int, f double")
    assert [r[0] for r in e.select(detector_status(F.col("e"), F.col("f"))).collect()] == ["ok", "alert", "alert", "alert", "warn"]


def test_robust_scale_steps(spark):
    groups = {"mad": [1.0, 2.0, 3.0, 4.0, 9.0], "iqr": [0.0] * 5 + [4.0] * 3, "sd": [0.0] * 9 + [10.0], "one": [0.0] * 4}
    frame = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("mad", None)], "k string, value double")
    got = {r.k: (r.med, r.scale) for r in peers.robust_scale(frame, ["k"]).collect()}
    assert got["mad"] == (3.0, pytest.approx(1.4826))
    assert got["iqr"][1] == pytest.approx(np.subtract(*np.percentile(groups["iqr"], [75, 25])) / 1.349)
    assert got["sd"][1] == pytest.approx(3.0) and got["one"] == (0.0, 1.0)


def plain_gate(flag, n, fast, enough):
    if not enough:
        return ("NORMAL", "SPIRITED_DRIVER_HIGH_SPEED_HIGH_RPM") if fast else ("WATCH" if flag else "NORMAL", "INSUFFICIENT_PEERS")
    if fast and n <= 1:
        return "NORMAL", "SPIRITED_DRIVER_HIGH_SPEED_HIGH_RPM"
    if flag:
        return ("ELEVATED", "ML_AND_DUAL") if n >= 2 else ("WATCH", "ML_PLUS_ONE_DUAL" if n else "ML_ONLY_PATTERN")
    return ("WATCH", "PHYSICS_ONLY_NO_ML") if n else ("NORMAL", "NO_ML_NO_DUAL")


def test_gate_truth_table(spark):
    cases = [(f, n, s, e) for f in (True, False) for n in range(4) for s in (True, False) for e in (True, False)]
    frame = spark.createDataFrame(cases, "f boolean, n int, s boolean, e boolean")
    for r in frame.select("*", peers.gate(F.col("f"), F.col("n"), F.col("s"), F.col("e")).alias("g")).collect():
        assert tuple(r.g) == plain_gate(r.f, r.n, r.s, r.e)


@pytest.mark.parametrize(("n", "scored"), [(8, 0), (9, 9)])
def test_too_few_peers(spark, n, scored):
    frame = spark.createDataFrame([("v", str(i), *[float(i * (j + 1) % 7) for j in range(9)]) for i in range(n)], ["variant", "imei", *peers.MATCH_FEATURES])
    assert peers.find_peers(frame).select("imei").distinct().count() == scored


def test_forest():
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (60, 4)), rng.normal(9, 1, (60, 4)), [[30, -30, 30, -30]]])
    trees = [ml.grow_tree(x, 1, t) for t in range(100)]
    scores = ml.forest_score(trees, x, len(x))
    assert scores.argmax() == 120 and 0.3 < np.median(scores) < 0.6
    for rows in trees:
        nodes = {r[0]: r for r in rows}
        assert all((2 * n in nodes and 2 * n + 1 in nodes) == (r[1] >= 0) for n, r in nodes.items())


def test_whole_run(spark, tmp_path):
    raw = synthetic.build(spark, 60)
    raw.write.option("header", True).csv(f"{tmp_path}/csv")
    run = Run(telemetry.read_csv(spark, f"{tmp_path}/csv"))
    records = {r.imei: r for r in run.verdicts().collect()}
    assert len(records) == 60
    faulty = [f"86{v:013d}" for v in range(60) if v % 7 == 0]
    assert sum(records[i].strong_metric_count > 0 for i in faulty) >= 7
    assert any(records[i].verdict == "ELEVATED" for i in faulty)
    assert all(r.explanations and len(r.trips) == r.n_trips for r in records.values())
    share = run.flags.agg(F.avg(F.col("cluster_outlier").cast("double"))).collect()[0][0]
    assert 0.08 <= share <= 0.2
    run.write(f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out/verdicts")
    assert back.count() == 60 and sinks.lookup(back, faulty[0]).count() == 1
    lines = sinks.read_json_records(spark, f"{tmp_path}/out/verdicts_json", back.schema)
    assert lines.where("verdict = 'ELEVATED'").count() == back.where("verdict = 'ELEVATED'").count()
    reference = sinks.read_fleet_csv(spark, f"{tmp_path}/out/fleet_reference_csv", spark.read.parquet(f"{tmp_path}/out/fleet_reference").schema)
    assert reference.count() == run.fleet_reference().count()
    assert "</script>" in run.dashboard_page() and faulty[0] in run.dashboard_page()
    assert "Deviations" in run.report(faulty[0])
    assert set(run.dashboard()) >= {"records", "clusters", "totals", "fleet_histograms"}


def test_streamed_trips_equal_batch(spark, tmp_path):
    clean = telemetry.clean(synthetic.build(spark, 4))
    end = clean.limit(1).select("variant", F.lit("end").alias("imei"), F.lit(dt.datetime(2030, 1, 1)).cast("timestamp").alias("time"), *[c for c in clean.columns if c not in ("variant", "imei", "time")]).withColumns({"state": F.lit(2).cast("short"), "speed": F.lit(1.0)})
    clean.coalesce(1).sortWithinPartitions("time").write.parquet(f"{tmp_path}/a/1")
    end.coalesce(1).write.parquet(f"{tmp_path}/a/2")
    stream = spark.readStream.schema(clean.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/a/*")
    q = streaming_trips(stream).writeStream.format("memory").queryName("streamed").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.imei, r.first_time, r.n_rows) for r in spark.table("streamed").collect()}
    batch = sessions.trips_of(clean).groupBy("imei", "trip_id").agg(F.min("time").alias("t"), F.count("*").alias("n")).collect()
    assert got == {(r.imei, r.t, r.n) for r in batch}


def test_empty_and_missing(spark):
    empty = rows(spark, [{"s": 0}]).limit(0)
    limits = detectors.variant_thresholds(empty)
    t = trips.trip_table(empty, limits)
    p = trips.profiles(t, trips.charge_summary(empty, limits))
    assert t.count() == 0 and p.count() == 0 and ml.outlier_flags(ml.vehicle_features(empty)).count() == 0
    with pytest.raises(ValueError, match="no telemetry"):
        telemetry.require_rows(empty)
    assert explain.strength(F.lit(3.2)) is not None and PROXY.trip_gap == 45.0


def test_peers_in_blocks_equal_all_distances(spark):
    """Tiles of a few vehicles give what all distances give, ties by id included."""
    import math

    rows = [("v", str(i), *[float((i * (j + 3)) % 11) for j in range(9)]) for i in range(60)] + [("w", str(i), *[1.0] * 9) for i in range(30)]
    frame = spark.createDataFrame(rows, ["variant", "imei", *peers.MATCH_FEATURES])
    scaled = {(r.variant, r.imei): r.v for r in peers.scaled_features(frame).collect()}
    want = set()
    for (variant, imei), v in scaled.items():
        far = sorted((round(math.dist(v, w), 9), peer) for (other, peer), w in scaled.items() if other == variant and peer != imei)
        want |= {(variant, imei, peer, rank) for rank, (_, peer) in enumerate(far[:20], 1)}
    for block in (7, 2000):
        got = peers.find_peers(frame, block=block)
        assert {(r.variant, r.imei, r.peer, r.rank) for r in got.collect()} == want
    assert peers.find_peers(frame.limit(0)).collect() == []


def test_counted_percentiles(spark):
    """Ranks over many small partitions equal numpy's percentiles; ties, one value and absent groups included."""
    import numpy as np

    from fleetlens.functions.quantiles import counted_percentiles

    rng = np.random.default_rng(5)
    groups = {"big": rng.normal(size=4000).round(2), "ties": np.repeat([1.0, 2.0], [7, 3]), "one": np.array([4.5])}
    rows = [(g, float(v), int(n)) for g, x in groups.items() for v, n in zip(*np.unique(x, return_counts=True))] + [("none", 1.0, 0)]
    got = counted_percentiles(spark.createDataFrame(rows, "g string, value double, n long"), ["g"], [0.25, 0.5, 0.9, 0.95])
    found = {r.g: r.p for r in got.collect()}
    assert set(found) == set(groups)
    for g, x in groups.items():
        assert np.allclose(found[g], np.quantile(x, [0.25, 0.5, 0.9, 0.95]))


def clustered(n):
    import pandas as pd

    rng = np.random.default_rng(2)
    x = np.round(np.vstack([rng.normal(-3, 0.5, (n // 2, len(ml.FEATURES))), rng.normal(3, 0.5, (n - n // 2, len(ml.FEATURES)))]), 6)
    return x, pd.DataFrame(x, columns=list(ml.FEATURES)).assign(variant="v", imei=[str(i) for i in range(n)], cohort=n)


def test_outlier_fit_uses_every_vehicle(spark):
    """Two clear clusters are found among all vehicles and their centres are means over all; each tree draws from all."""
    x, frame = clustered(5000)
    big = spark.createDataFrame(frame).repartition(7)
    centres = ml.chosen_centres(big)["v"]
    own = ml.nearest(x, centres)[0]
    assert len(centres) == 2 and len(set(own[:2500])) == 1 and own[0] != own[-1]
    assert np.allclose(centres, [x[own == c].mean(0) for c in range(2)], atol=1e-6)
    forest = ml.grown_forests(big).groupBy("tree").agg(F.count("*").alias("n"), F.max("node").alias("last")).collect()
    assert len(forest) == DEFAULT.trees and all(r.n > 1 and r.last < 512 for r in forest)


def test_silhouette_equals_plain_numpy(spark, monkeypatch):
    monkeypatch.setattr(ml, "TILE", 70)
    x, frame = clustered(300)
    labels = {2: (np.arange(300) % 7 > 2).astype(int), 3: np.where(np.arange(300) == 0, 2, (np.arange(300) >= 150).astype(int))}
    frame["labels"] = [{k: int(v[i]) for k, v in labels.items()} for i in range(300)]
    schema = ", ".join(f"{f} double" for f in ml.FEATURES) + ", variant string, imei string, cohort long, labels map<int,int>"
    got = {r.k: r.silhouette for r in ml.silhouettes(spark.createDataFrame(frame, schema)).collect()}
    for k, own in labels.items():
        assert np.isclose(got[k], ml.silhouette(x, own), rtol=1e-9)


def test_seeding_does_not_depend_on_partitions(spark):
    _, frame = clustered(120)
    starts = [ml.start_centres(spark.createDataFrame(frame).repartition(n))["v"] for n in (1, 5)]
    assert all(np.array_equal(a, b) for a, b in zip(*starts)) and all(len(c) == DEFAULT.k_max for c in starts[0])


def test_find_record(spark, tmp_path):
    """A record is found beside a damaged line; a missing vehicle or folder gives none."""
    from fleetlens.sources import sinks

    path = tmp_path / "records"
    path.mkdir()
    (path / "a.json").write_text('{"imei": "7", "verdict": "WATCH"}\n{"imei": "8", "verd\n')
    schema = "imei string, verdict string"
    assert sinks.find_record(spark, str(path), schema, "7") == {"imei": "7", "verdict": "WATCH"}
    assert sinks.find_record(spark, str(path), schema, "8") is None
    assert sinks.find_record(spark, str(tmp_path / "absent"), schema, "7") is None
