"""Documents of records, the older forms, runs from given flags, places in an order."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from fleetlens.__main__ import main
from fleetlens.config import DETECTORS
from fleetlens.functions.positions import positioned
from fleetlens.operators import forms
from fleetlens.sources import documents, sinks, synthetic

LABELS = {f"{d}_rate": t for d, t in DETECTORS.items()}


def whole(path):
    """The document as one program would read it: its parts put together."""
    return json.loads("".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*"))))


@pytest.mark.parametrize("partitions", [1, 7])
def test_document_round_trip(spark, tmp_path, partitions):
    rows = [("b", 2, ["x,\"]}", "vehicles\":["], None), ("a", 1, [], 0.5), ("a", 1, [], 0.5), (",é\n", 3, None, None)]
    table = spark.createDataFrame(rows, "imei string, n bigint, tags array<string>, z double").repartition(partitions)
    documents.write(table.orderBy("n"), f"{tmp_path}/d", version="v", facts={"k": 1})
    read = whole(f"{tmp_path}/d")
    assert (read["version"], read["facts"]) == ("v", {"k": 1})
    assert [v["n"] for v in read["vehicles"]] == [1, 1, 2, 3] and read["vehicles"][3] == {"imei": ",é\n", "n": 3, "tags": None, "z": None}
    back = documents.read(spark, f"{tmp_path}/d")
    assert back.schema == table.schema and sorted(back.collect(), key=str) == sorted(table.collect(), key=str)
    assert documents.head(spark, f"{tmp_path}/d")["vehicles"] == []


def test_empty_document_and_no_document(spark, tmp_path):
    none = spark.createDataFrame([], "imei string, n int")
    documents.write(none, f"{tmp_path}/d")
    assert whole(f"{tmp_path}/d")["vehicles"] == [] and documents.read(spark, f"{tmp_path}/d").collect() == []
    (tmp_path / "x").write_text("{}\n")
    with pytest.raises(ValueError, match="no document"):
        documents.read(spark, f"{tmp_path}/x")


def test_flags_of_another_program(spark, tmp_path):
    vehicles = [dict(imei=861234567890123, variant="v", is_anomaly=True, isolation_score=0.5, cluster_id=1, severity="HIGH"), dict(imei="86.0", variant="v", is_anomaly=None), dict(imei="nan", variant="v")]
    (tmp_path / "flags.json").write_text(json.dumps({"stage": "stage1", "vehicles": vehicles}, indent=2))
    got = {r.imei: r for r in documents.read_flags(spark, f"{tmp_path}/flags.json", whole=True).collect()}
    assert set(got) == {"861234567890123", "86"} and got["861234567890123"].is_anomaly and got["86"].is_anomaly is False
    assert got["86"].n_records is None and got["86"].cluster_outlier is None


def test_positions(spark):
    n = 1000
    got = positioned(spark.range(n).repartition(8).orderBy(F.desc("id"))).collect()
    assert all(r.position == n - r.id for r in got) and len(got) == n
    assert positioned(spark.range(0).orderBy("id")).collect() == []


def plain_summary(vehicles, form):
    """Counts of an older form in plain Python."""
    n = lambda test: sum(1 for v in vehicles if test(v))
    by = lambda key, rows: {k: sum(1 for v in rows if (v[key] or "UNSPECIFIED") == k) for k in {v[key] or "UNSPECIFIED" for v in rows}}
    watch = [v for v in vehicles if v["verdict"] == "WATCH"]
    return {
        "total_validated": len(vehicles), "high": 0, "elevated": n(lambda v: v["verdict"] == "ELEVATED"), "watch": len(watch), "detector_flagged": n(lambda v: v["detector_flag"]),
        "valid_trips": sum(v["n_trips"] or 0 for v in vehicles), "no_valid_trips": n(lambda v: v["watch_reason"] == "NO_VALID_TRIPS") if form == "piped" else 0,
        "vehicles_with_valid_trips": n(lambda v: (v["n_trips"] or 0) > 0) if form == "piped" else len(vehicles),
        "verdict_counts": by("verdict", vehicles), "watch_reason_counts": by("watch_reason", vehicles if form == "piped" else watch),
    }


def test_older_summaries(spark):
    rows = [("a", "v", "WATCH", "ML_ONLY_PATTERN", True, False, 3), ("b", "v", "WATCH", "", False, False, 0), ("c", "w", "NORMAL", "SPIRITED", False, True, 2), ("d", "w", "WATCH", "NO_VALID_TRIPS", False, False, None), ("e", "w", "ELEVATED", None, True, True, 1)]
    table = spark.createDataFrame(rows, "imei string, variant string, verdict string, watch_reason string, detector_flag boolean, spirited boolean, n_trips bigint")
    for form in forms.JOINS:
        got = forms.summary(table, form).first().asDict(recursive=True)
        expected = plain_summary([r.asDict() for r in table.collect()], form)
        assert {k: got[k] for k in expected} == expected
        assert got["pipeline_version"].endswith("-via-adapter") == (form == "piped")
        empty = forms.summary(table.limit(0), form).first().asDict(recursive=True)
        assert empty["total_validated"] == 0 and empty["watch_reason_counts"] == {} and empty["vehicles_with_valid_trips"] == 0


def test_stages_one_by_one_equal_a_whole_run(spark, tmp_path):
    """Flags first, verdicts from the written flags, both older forms from the written verdicts."""
    csv, out, other = f"{tmp_path}/csv", f"{tmp_path}/out", f"{tmp_path}/other"
    synthetic.build(spark, 24).write.option("header", True).csv(csv)
    common = ["--csv", csv, "--out", out, "--flags-path", f"{tmp_path}/flags"]
    main([*common, "run", "--stage", "1"])
    flags = whole(f"{tmp_path}/flags")
    assert flags["stage"] == "stage1" and flags["n_vehicles"] == 24 == len(flags["vehicles"]) and flags["n_anomalies"] == sum(v["is_anomaly"] for v in flags["vehicles"])
    main([*common, "run", "--stage", "2", "--dashboard"])
    main(["--csv", csv, "--out", other, "run"])
    assert whole(f"{tmp_path}/flags") == flags and whole(f"{other}/flags_document") == flags
    verdicts = whole(f"{out}/verdicts_document")
    facts = lambda d: {k: v for k, v in d.items() if k != "schema"}
    assert facts(verdicts) == facts(whole(f"{other}/verdicts_document"))
    assert whole(f"{out}/summary_document") == verdicts["summary"] and verdicts["summary"]["params"]["peers"] == 20
    rank = {"ELEVATED": 0, "WATCH": 1, "NORMAL": 2}
    order = [(rank[v["verdict"]], -v["strong_metric_count"], v["variant"], v["imei"]) for v in verdicts["vehicles"]]
    assert order == sorted(order) and glob.glob(f"{out}/dashboard_page/part-*")
    for form, joint in forms.JOINS.items():
        main(["--out", out, "export", form])
        older = whole(f"{out}/verdicts_{form}")
        assert [(v["imei"], v["trips"], v["explanations"]) for v in older["vehicles"]] == [(v["imei"], v["trips"], v["explanations"]) for v in verdicts["vehicles"]]
        expected = plain_summary(verdicts["vehicles"], form)
        assert {k: older["summary"][k] for k in expected} == expected
        for v in older["vehicles"]:
            assert v["strong_metrics"] == joint.join(LABELS[i] for i in v["strong_metric_ids"])
    main(["--csv", csv, "--out", out, "--flags-path", f"{tmp_path}/flags", "dashboard", "--given-flags", "--no-charts"])
    assert {f.split("/")[-1] for f in glob.glob(f"{out}/dashboard/*")} == {f"{t}{end}" for t in ("records", "clusters", "totals") for end in ("", "_json")}


def test_given_text_stays(spark):
    base = "'1' as imei, 'v' as variant, 'NORMAL' as verdict, '' as watch_reason, false as spirited, 3L as n_trips, 20L as n_peers, 1 as strong_metric_count, array('d6_torque_speed_rate', 'other') as strong_metric_ids"
    dets = ", ".join(f"0L as {d}_events_total, 0D as {d}_max_dwell_s, 0D as {d}_rate, 0D as {d}_z" for d in DETECTORS)
    made = lambda form, given=None: forms.records(spark.sql(f"select {base}, {dets}" + (f", '{given}' as strong_metrics" if given is not None else "")), form).first().strong_metrics
    name = LABELS["d6_torque_speed_rate"]
    assert made("piped") == f"{name} | other" and made("listed") == f"{name}; other"
    assert made("piped", "kept") == "kept" == made("listed", "kept")
    assert made("piped", "") == "" and made("listed", "") == f"{name}; other"
