"""Command line: python -m fleetlens {demo,run,flags,reference,report,dashboard,export} ..."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.shared import staged
from fleetlens.operators import ml, peers
from fleetlens.plans.pipeline import Run, from_csv, write_flags, write_older_form
from fleetlens.sources import documents, sinks, synthetic, telemetry


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="fleetlens", description=__doc__)
    p.add_argument("--csv", default=os.environ.get("FLEET_INPUT_CSV", "data/telemetry"), help="telemetry CSV file or folder")
    p.add_argument("--out", default=os.environ.get("FLEET_OUT", "out"), help="output folder")
    p.add_argument("--keep", default=os.environ.get("FLEET_KEEP"), help="shared folder that keeps cleaned telemetry and thresholds for later runs")
    for name in ("flags", "verdicts", "summary"):
        p.add_argument(f"--{name}-path", default=os.environ.get(f"FLEET_{name.upper()}_OUT"), help=f"place of the {name} document (default: {name}_document in --out)")
    p.add_argument("--whole", action="store_true", help="documents that are read are single files of another program")
    sub = p.add_subparsers(dest="what", required=True)
    demo = sub.add_parser("demo", help="write synthetic telemetry to --csv")
    demo.add_argument("--vehicles", type=int, default=30)
    demo.add_argument("--seed", type=int, default=42)
    run_ = sub.add_parser("run", help="flags, verdicts, summary and fleet reference")
    run_.add_argument("--stage", choices=["1", "2", "all"], default="all", help="1: flags alone; 2: start from the flags document")
    run_.add_argument("--dashboard", action="store_true", help="the dashboard page too")
    sub.add_parser("flags", help="outlier flags only")
    sub.add_parser("reference", help="fleet reference only")
    dashboard = sub.add_parser("dashboard", help="one HTML page of verdicts, and the dashboard tables")
    dashboard.add_argument("--given-flags", action="store_true", help="start from the flags document")
    dashboard.add_argument("--no-charts", action="store_true", help="neither statistics, histograms nor maps")
    export = sub.add_parser("export", help="the verdict document in an older form")
    export.add_argument("form", choices=["piped", "listed"])
    report = sub.add_parser("report", help="HTML reports: one vehicle, or all of a verdict")
    report.add_argument("imei", nargs="?")
    report.add_argument("--verdict", choices=["ELEVATED", "WATCH", "NORMAL"], default="ELEVATED")
    report.add_argument("--variant")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("fleetlens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.what == "demo":
        synthetic.build(spark, a.vehicles, a.seed).write.mode("overwrite").option("header", True).csv(a.csv)
    elif a.what == "export":
        write_older_form(spark, a.verdicts_path or f"{a.out}/verdicts_document", f"{a.out}/verdicts_{a.form}", a.form, whole=a.whole)
    elif a.what == "flags" or a.what == "run" and a.stage == "1":
        write_flags(ml.outlier_flags(ml.vehicle_features(telemetry.require_rows(telemetry.read_csv(spark, a.csv)))), a.out, document=a.flags_path)
    else:
        given = a.what == "run" and a.stage == "2" or a.what == "dashboard" and a.given_flags
        flags = staged(documents.read_flags(spark, a.flags_path or f"{a.out}/flags_document", a.whole)) if given else None
        run: Run = from_csv(spark, a.csv, keep=a.keep, flags=flags)
        if a.what == "run":
            run.write(a.out, a.flags_path, a.verdicts_path, a.summary_path)
            if a.dashboard:
                sinks.write_page(spark, run.dashboard_page(), f"{a.out}/dashboard_page")
        elif a.what == "reference":
            sinks.write_csv(run.fleet_reference(), f"{a.out}/fleet_reference_csv")
        elif a.what == "dashboard":
            sinks.write_page(spark, run.dashboard_page(), f"{a.out}/dashboard_page")
            run.write_dashboard(a.out, not a.no_charts)
        else:
            chosen = run.rows.where(F.col("imei") == a.imei) if a.imei else peers.targets(run.judged, a.verdict)
            run.reports(chosen.where(F.col("variant") == a.variant) if a.variant else chosen, f"{a.out}/reports")


if __name__ == "__main__":
    main()
