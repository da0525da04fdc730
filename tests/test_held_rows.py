"""Trips and charges of a query read the rows from one written table."""

from fleetlens.config import PROXY
from fleetlens.operators import sessions, trips
from fleetlens.plans.queries import Base
from fleetlens.sources import proxy

SF = "/root/testdata/sf0.001"


def test_rows_are_shuffled_once(spark):
    b = Base(spark, SF)
    plan = b.charges._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in plan and "l_quantity" not in plan
    assert b.held.dtypes == b.rows.dtypes and sorted(map(tuple, b.held.collect())) == sorted(map(tuple, b.rows.collect()))
    fresh = trips.charge_summary(b.rows, b.thresholds, PROXY)
    assert sorted(map(tuple, b.charges.collect())) == sorted(map(tuple, fresh.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_by_vehicle_are_not_shuffled_again(spark):
    b = Base(spark, SF)
    assert _plan(b.held.groupBy("variant", "imei").count()).count("Exchange") == 0
    whole = trips.trip_table(b.held, b.thresholds, PROXY, whole=True)
    # What is left are the two sides of joins by trip and by session, and the vehicles.
    assert _plan(whole).count("Exchange hashpartitioning") <= 2 and _plan(b.charges).count("Exchange hashpartitioning") <= 4
    fresh = trips.trip_table(b.rows, b.thresholds, PROXY)
    assert sorted(map(str, whole.collect())) == sorted(map(str, fresh.select(whole.columns).collect())) and whole.count() > 0


def test_runs_and_sessions_of_whole_vehicles_equal_slices(spark):
    rows = Base(spark, SF).rows
    for of in (sessions.trips_of, sessions.charge_sessions_of):
        name = "trip_id" if of is sessions.trips_of else "session_id"
        seen = [sorted(map(str, of(rows, PROXY, whole=w).select("variant", "imei", "seq", "gap", name, "place").collect())) for w in (False, True)]
        assert seen[0] == seen[1] and seen[0]


def test_buckets_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(proxy, "BUCKET_ROWS", 500)
    rows = proxy.telemetry(spark, SF)
    held = proxy.bucketed_telemetry(spark, SF)
    assert f"{-(-rows.count() // 500)} out of" in _plan(held.groupBy("variant", "imei").count()) and sorted(map(str, held.collect())) == sorted(map(str, rows.collect()))
