"""Telemetry by name, reports of many vehicles in one job, and the dashboard page."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT
from fleetlens.plans import reports
from fleetlens.plans.pipeline import Run
from fleetlens.sources import sinks, synthetic, telemetry

HEADER = list(telemetry.RAW)


def line(**values):
    base = dict(time="2024-01-01 00:00:00", imei="1", vehicle_model_name="m", vehicle_variant_name="v", vehicleState="2")
    return {**{c: "" for c in HEADER}, **base, **values}


def write(path, header, rows):
    path.write_text("\n".join([",".join(header), *[",".join(r[c] for c in header) for r in rows]]) + "\n")


def test_columns_go_by_the_name_in_each_file(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder / "a.csv", HEADER, [line(imei="1", rpm="1000", speed="30")])
    other = sorted(HEADER, reverse=True)
    write(folder / "b.csv", other, [line(imei="2", rpm="1000", speed="30")])
    write(folder / "c.csv", [*other, "extra"], [{**line(imei="3", rpm="1000", speed="30"), "extra": "x"}])
    (folder / "d.csv").write_text("")
    rows = telemetry.read_csv(spark, str(folder)).collect()
    assert sorted(r.imei for r in rows) == ["1", "2", "3"] and all((r.rpm, r.speed) == (1000.0, 30.0) for r in rows)
    write(folder / "e.csv", [c for c in HEADER if c != "speed"], [line()])
    with pytest.raises(ValueError, match="e.csv has no column speed"):
        telemetry.read_csv(spark, str(folder))


@pytest.fixture(scope="module")
def run(spark):
    """Twelve vehicles; the id of the first is in three variants. Flags are given, as too few are there to fit any."""
    rows = telemetry.clean(synthetic.build(spark, 12))
    first = rows.agg(F.min("imei")).first()[0]
    copies = rows.where(F.col("imei") == first)
    rows = rows.unionByName(copies.withColumn("variant", F.lit("m | second"))).unionByName(copies.withColumn("variant", F.lit("m | third")).withColumn("speed", F.col("speed") / 2))
    flags = rows.groupBy("variant", "imei").agg(F.count("*").alias("n_records")).withColumns(
        {"is_anomaly": F.lit(False), "isolation_score": F.lit(0.1), "distance_to_center": F.lit(0.1), "cluster_id": F.lit(0), "cluster_outlier": F.lit(False), "isolation_outlier": F.lit(False), "severity": F.lit("NORMAL"), "severity_tier": F.lit(0)}
    )
    return Run(rows, DEFAULT, flags), first


def test_pages_by_variant_and_id(run, tmp_path):
    made, first = run

    def render(variant, imei, sections):
        if variant == "m | second":
            raise ValueError("no <data>")
        return reports.page_of(variant, imei, sections)

    index = reports.write(made, made.trips, str(tmp_path / "out"), render).collect()
    keys = {tuple(r) for r in made.trips.select("variant", "imei").distinct().collect()}
    assert {(r.variant, r.imei) for r in index} == keys and len({v for v, i in keys if i == first}) == 3
    failed = [r for r in index if r.error]
    assert [(r.variant, r.error) for r in failed] == [("m | second", "ValueError: no <data>")]
    files = glob.glob(f"{tmp_path}/out/pages/*/*/part-*")
    assert len(files) == len(keys) - 1
    texts = {open(f, encoding="utf-8").read() for f in files}
    assert len(texts) == len(files) and all("Deviations" in t for t in texts)
    (page,) = glob.glob(f"{tmp_path}/out/index/part-*")
    text = open(page, encoding="utf-8").read()
    assert text.count("<a href") == len(keys) - 1 and "no &lt;data&gt;" in text
    lines = [json.loads(x) for f in glob.glob(f"{tmp_path}/out/index_json/part-*") for x in open(f, encoding="utf-8")]
    assert len(lines) == len(keys)


def test_one_report(run):
    made, first = run
    assert made.report(first, "m | third").count("<h1>") == 1 and made.report(first).count("<h1>") == 3
    with pytest.raises(LookupError):
        made.report("nobody")


def test_lookup_takes_the_variant(run):
    made, first = run
    assert sinks.lookup(made.judged, first, "m | third").select("variant").first().variant == "m | third"
    assert sinks.lookup(made.judged, first).count() == 1


def test_number_of_jobs_does_not_grow(run, spark):
    made, _ = run
    tracker = spark.sparkContext.statusTracker()
    counts = []
    for targets in (made.trips.limit(1), made.trips):
        spark.sparkContext.setJobGroup(f"reports-{len(counts)}", "reports")
        reports.pages(made, targets).count()
        counts.append(len(tracker.getJobIdsForGroup(f"reports-{len(counts)}")))
    # Broadcasts and empty stages come and go; a job for each further vehicle would be thirteen more at least.
    assert counts[1] < counts[0] + made.trips.select("variant", "imei").distinct().count() - 1


def test_dashboard_has_every_verdict(spark):
    class Many(Run):
        def __init__(self):
            self.settings = DEFAULT

        judged = property(lambda self: spark.range(501).select(F.lit("v").alias("variant"), F.col("id").cast("string").alias("imei"), F.lit("NORMAL").alias("verdict"), F.lit("").alias("watch_reason"), F.lit(0).alias("strong_metric_count"), F.array().alias("trips")))

    assert Many().dashboard_page().count('"imei":') == 501
