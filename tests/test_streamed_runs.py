"""Streamed dwell runs against those of the same rows in batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT
from fleetlens.operators import detectors, sessions
from fleetlens.streaming.dwell import streaming_runs
from tests.test_operators import SCHEMA, T0

KEYS = [c.split()[0] for c in SCHEMA.split(", ")]
LIMITS = {"throttle_p75": 1.0, "speed_p25": 1.0, "current_p25": 0.0, "charge_current_p75": 1.0}
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def row(imei, s, seq, **more):
    base = {"variant": "v", "imei": imei, "time": T0 + dt.timedelta(seconds=s), "seq": seq, "throttle": 1.0, "speed": 1.0, "current": 1.0, "soc": 97.0, "state": 2, "mode": 0} | more
    return tuple(base.get(c, 1.0) for c in KEYS)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKS)
    yield spark
    spark.conf.set(key, before) if before else spark.conf.unset(key)


def streamed(spark, tmp_path, files):
    limits = spark.createDataFrame([("v", *LIMITS.values())], ["variant", *LIMITS]).select("*", *[F.lit(None).cast("double").alias(t) for t in detectors.THRESHOLDS if t not in LIMITS])
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{i:03}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = streaming_runs(stream, limits).writeStream.format("memory").queryName(f"runs_{tmp_path.name}").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").start()
    q.processAllAvailable()
    q.stop()
    return spark.table(f"runs_{tmp_path.name}").collect(), limits


def test_streamed_runs_equal_batch(rocks, tmp_path):
    """Rows come up to ten minutes out of order; the last file pushes the watermark past all."""
    rng, rows = random.Random(8), []
    for v in range(3):
        s = 0
        for n in range(250):
            s += rng.choice([0, 5, 5, 5, 300, 900, 901, 2000]) if rng.random() < 0.2 else 5
            rows.append((s, row(str(v), s, n, throttle=float(rng.random() < 0.8), speed=rng.choice([0.0, 1.0, 1.0, 9.0]), current=rng.choice([0.0, 0.0, 1.0, 1.0, 1.0]), state=rng.choice([2, 2, 2, 1]))))
    # Whole-file order by arrival; no row is later than the watermark of fifteen minutes.
    rows.sort(key=lambda x: x[0] + rng.random() * 600)
    rows = [r for _, r in rows]
    files = [rows[i : i + 150] for i in range(0, len(rows), 150)] + [[row("end", 9_000_000, 0, speed=9.0)]]
    got, limits = streamed(rocks, tmp_path, files)
    frame = rocks.createDataFrame(rows, SCHEMA)
    want = []
    for numbered, unit, events in ((sessions.trips_of(frame), "trip_id", detectors.trip_events), (sessions.charge_sessions_of(frame), "session_id", detectors.charge_events)):
        key = ["variant", "imei", unit]
        began = numbered.groupBy(*key).agg(F.min("time").alias("unit_time"))
        want += events(numbered, limits).join(began, key).select("imei", "det", "unit_time", "events", "max_dwell_s").collect()
    found = {}
    for r in got:
        events, longest = found.get((r.imei, r.det, r.unit_time), (0, 0.0))
        found[r.imei, r.det, r.unit_time] = (events + 1, max(longest, r.dwell_s))
    assert found == {(r.imei, r.det, r.unit_time): (r.events, r.max_dwell_s) for r in want} and len({r.det for r in got}) == 3 and len(want) > 20


def test_late_rows_and_open_runs(rocks, tmp_path):
    """A row behind the watermark of the batch before is dropped; a run whose end the watermark has not passed is not returned yet."""
    run = [row("1", 5 * i, i) for i in range(4)] + [row("1", 20, 4, throttle=0.0)]
    files = [run, [row("2", 8000, 0, speed=9.0)], [row("1", 8000, 10)], [row("1", 10, 9, throttle=0.0)] + [row("1", 8005 + 5 * i, 11 + i) for i in range(4)]]
    got, _ = streamed(rocks, tmp_path, files)
    assert [(r.imei, r.det, r.run, r.dwell_s, r.first_time, r.last_time) for r in got if r.det.startswith("d2")] == [("1", "d2_throttle_speed", 4, 20.0, T0, T0 + dt.timedelta(seconds=15))]
    assert DEFAULT.dwell["d2_throttle_speed"] == 4
