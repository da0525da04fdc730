"""Sessions and dwell runs over slices of time against plain Python over whole vehicles."""

import datetime as dt
import random
import re
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT
from fleetlens.functions.shared import staged
from fleetlens.operators import detectors, sessions
from tests.test_operators import SCHEMA, T0, rows as made_rows

KEYS = [c.split()[0] for c in SCHEMA.split(", ")]


def telemetry(spark, vehicles, samples, seed=3):
    """The first vehicle has half of all rows; steps lie on both sides of the gap and of slice edges, with equal times."""
    rng, out = random.Random(seed), []
    for v in range(vehicles):
        s = 0
        for n in range(samples * (vehicles - 1) if v == 0 else samples):
            s += rng.choice([0, 5, 5, 5, 5, 300, 900, 901, 2000]) if rng.random() < 0.3 else 5
            row = {"variant": "v", "imei": str(v), "time": T0 + dt.timedelta(seconds=s), "seq": n, "throttle": float(rng.random() < 0.8), "speed": rng.choice([0.0, 1.0, 1.0, 1.0, 9.0]), "state": rng.choice([2, 2, 2, 1]), "soc": 97.0, "current": 30.0}
            out.append(tuple(row.get(c, 0 if c == "mode" else 1.0) for c in KEYS))
    rng.shuffle(out)
    return spark.createDataFrame(out, SCHEMA).repartition(5), [dict(zip(KEYS, r, strict=True)) for r in out]


def plain_numbers(found, first, limit=900.0):
    vehicles, out = defaultdict(list), {}
    for r in found:
        vehicles[r["imei"]].append((r["time"], r["seq"]))
    for imei, at in vehicles.items():
        at.sort()
        number = first
        for i, (t, seq) in enumerate(at):
            gap = (t - at[i - 1][0]).total_seconds() if i else None
            number += gap is not None and gap > limit
            out[imei, seq] = (gap, number, i + 1)
    return out


@pytest.mark.parametrize("slice_gaps", [1, 3, 96, 100_000])
def test_numbers_do_not_depend_on_slices(spark, slice_gaps):
    frame, found = telemetry(spark, 4, 150)
    settings = replace(DEFAULT, slice_gaps=slice_gaps)
    for of, name, first, keep in (
        (sessions.trips_of, "trip_id", 0, lambda r: r["state"] == 2 and r["speed"] > 0),
        (sessions.charge_sessions_of, "session_id", 1, lambda r: r["state"] == 1),
    ):
        got = {(r.imei, r.seq): (r.gap, r[name], r.place) for r in of(frame, settings).collect()}
        assert got == plain_numbers([r for r in found if keep(r)], first)


@pytest.mark.parametrize("slice_gaps", [1, 96])
def test_runs_over_the_edges_of_slices_are_one(spark, slice_gaps):
    frame, found = telemetry(spark, 4, 150)
    settings = replace(DEFAULT, slice_gaps=slice_gaps)
    limits = spark.createDataFrame([("v", 1.0, 1.0)], "variant string, throttle_p75 double, speed_p25 double").select("*", *[F.lit(None).cast("double").alias(t) for t in detectors.THRESHOLDS if t not in ("throttle_p75", "speed_p25")])
    got = detectors.trip_events(sessions.trips_of(frame, settings), limits, settings, ["d2_throttle_speed"]).collect()
    moving = [r for r in found if r["state"] == 2 and r["speed"] > 0]
    number, hits = plain_numbers(moving, 0), defaultdict(list)
    for r in sorted(moving, key=lambda r: (r["time"], r["seq"])):
        hits[r["imei"], number[r["imei"], r["seq"]][1]].append(r["throttle"] >= 1 and r["speed"] <= 1)
    want = {}
    for unit, mask in hits.items():
        runs = [len(x) for x in "".join("x" if m else " " for m in mask).split()]
        if runs := [n for n in runs if n >= 4]:
            want[unit] = (len(runs), 5.0 * max(runs), pytest.approx(5.0 * sum(runs) / len(runs)))
    assert {(r.imei, r.trip_id): (r.events, r.max_dwell_s, r.mean_dwell_s) for r in got} == want and len(want) > 10


def test_a_long_run_over_many_slices(spark):
    """One true run of 900 rows over many slices, then one row short of the dwell on both sides of an edge."""
    times = [100 * i for i in range(900)] + [91_700, 91_750]
    rows = [tuple({"variant": "v", "imei": "1", "time": T0 + dt.timedelta(seconds=s), "seq": i, "state": 2, "throttle": 1.0, "speed": 1.0, "mode": 0}.get(c, 1.0) for c in KEYS) for i, s in enumerate(times)]
    limits = spark.createDataFrame([("v", 1.0, 1.0)], "variant string, throttle_p75 double, speed_p25 double").select("*", *[F.lit(None).cast("double").alias(t) for t in detectors.THRESHOLDS if t not in ("throttle_p75", "speed_p25")])
    settings = replace(DEFAULT, slice_gaps=1)
    numbered = sessions.trips_of(spark.createDataFrame(rows, SCHEMA), settings)
    assert numbered.groupBy("slice").count().agg(F.max("count")).first()[0] == 9
    got = detectors.trip_events(numbered, limits, settings, ["d2_throttle_speed"]).collect()
    assert [(r.trip_id, r.events, r.max_dwell_s) for r in got] == [(0, 1, 4500.0)]


def test_no_window_holds_all_rows_of_a_vehicle(spark):
    frame, _ = telemetry(spark, 4, 20)
    plan = sessions.trips_of(frame)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window [" in x]
    # Those by vehicle alone are over the table of slices.
    by_vehicle = [x for x in windows if "slice" not in x.split("], [")[1]]
    assert windows and by_vehicle and all("time#" not in x and "seq#" not in x for x in by_vehicle)
    assert sessions.trips_of(frame.limit(0)).count() == 0


def test_runs_are_read_from_the_window(spark):
    """No aggregate by run: the memory of a task does not grow with the runs that it holds."""
    frame = spark.createDataFrame([(1, "a", i, i % 3 > 0) for i in range(30)], "u int, det string, place int, hit boolean")
    runs = sessions.dwell_runs(frame, ["u"], {"a": 2}, 5.0)
    assert [tuple(r)[2:] for r in runs.collect()] == [(10, 10.0, 10.0)]
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "island" not in plan


def test_thresholds_put_no_variant_into_one_task(spark):
    """Their join is a broadcast behind a count, also where sizes are unknown."""
    r = made_rows(spark, [{"s": i * 5} for i in range(20)])
    limits = staged(detectors.variant_thresholds(r))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for events in (detectors.trip_events(sessions.trips_of(r), limits), detectors.charge_events(sessions.charge_sessions_of(r), limits)):
            plan = events._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\(variant#\d+, \d+\)", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
