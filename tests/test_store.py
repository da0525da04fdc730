"""Telemetry kept between runs: no second cleaning, no stale table, no shuffle of the rows."""

import re
import shutil

import pytest

from fleetlens.config import DEFAULT
from fleetlens.functions.core import VEHICLE
from fleetlens.operators import sessions, trips
from fleetlens.plans.pipeline import Run
from fleetlens.sources import store, synthetic, telemetry


def test_second_run_reads_no_csv(spark, tmp_path, monkeypatch):
    csv, keep = f"{tmp_path}/csv", f"{tmp_path}/keep"
    synthetic.build(spark, 6).repartition(2).write.option("header", True).csv(csv)
    plain = telemetry.read_csv(spark, csv)
    rows, limits = store.kept_telemetry(spark, csv, keep)
    assert sorted(map(str, rows.select(*telemetry.CLEAN).collect())) == sorted(map(str, plain.select(*telemetry.CLEAN).collect()))
    want = sorted(map(str, sessions.trips_of(plain).select(*VEHICLE, "seq", "trip_id", "place").collect()))

    def fails(*_):
        raise AssertionError("telemetry was cleaned again")

    with monkeypatch.context() as patched:
        patched.setattr(telemetry, "read_csv", fails)
        # A later session knows the files alone.
        for name in (t.name for t in spark.catalog.listTables() if t.name.startswith(("telemetry_", "thresholds_"))):
            spark.sql(f"DROP TABLE {name}")
        again, limits_again = store.kept_telemetry(spark, csv, keep)
        assert sorted(map(str, sessions.trips_of(again).select(*VEHICLE, "seq", "trip_id", "place").collect())) == want
        assert sorted(map(str, limits_again.collect())) == sorted(map(str, limits.collect()))
        run = Run(again, DEFAULT, flags=spark.createDataFrame([], "variant string"), thresholds=limits_again)
        assert run.rows is again and run.trips.count() == trips.trip_table(plain, limits).count() > 0
        # Numbering shuffles the rows of slices, never those of telemetry.
        plan = sessions.trips_of(again)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 2 and not re.search(r"hashpartitioning\(variant#\d+, imei#\d+, slice#\d+L?, \d+\), ENSURE_REQUIREMENTS, \[plan_id=\d+\]\s*\n[^\n]*Filter", plan)
        with pytest.raises(AssertionError, match="cleaned again"):
            store.kept_telemetry(spark, csv, keep, DEFAULT.__class__(trip_gap=600.0))

    # One more file: another key, and its rows are there.
    more = f"{tmp_path}/more"
    synthetic.build(spark, 2, 7).coalesce(1).write.option("header", True).csv(more)
    for file in (tmp_path / "more").glob("part-*.csv"):
        shutil.copy(file, f"{csv}/{file.name}")
    grown, _ = store.kept_telemetry(spark, csv, keep)
    assert grown.count() == telemetry.read_csv(spark, csv).count() > rows.count()


def test_unfinished_table_is_written_again(spark, tmp_path):
    import os

    made = []

    def build():
        made.append(1)
        return spark.range(5)

    keep = f"{tmp_path}/keep"
    name = f"range_{os.getpid()}"
    assert store.kept(spark, keep, name, build).count() == 5 and store.kept(spark, keep, name, build).count() == 5 and len(made) == 1
    os.remove(f"{keep}/{name}/_SUCCESS")
    assert store.kept(spark, keep, name, build).count() == 5 and len(made) == 2
