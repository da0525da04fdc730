"""Whole runs: telemetry to verdicts, fleet reference, dashboard data and reports."""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, Settings
from fleetlens.functions.core import VEHICLE
from fleetlens.functions.shared import staged
from fleetlens.operators import detectors, explain, fleet, forms, histograms, ml, peers, sessions, trips
from fleetlens.plans import reports
from fleetlens.sources import documents, sinks


class Run:
    """All tables of one telemetry input. Each is planned once and staged where branches share it."""

    def __init__(self, rows: DataFrame, settings: Settings = DEFAULT, flags: DataFrame | None = None, thresholds: DataFrame | None = None):
        """``thresholds`` come with rows that are kept as a table already; other rows are staged here."""
        self.settings = settings
        self.given_flags = flags is not None
        self.rows = staged(rows) if thresholds is None else rows
        self.thresholds = staged(detectors.variant_thresholds(self.rows, settings)) if thresholds is None else thresholds
        self.trips = staged(trips.trip_table(self.rows, self.thresholds, settings))
        self.profiles = staged(trips.profiles(self.trips, trips.charge_summary(self.rows, self.thresholds, settings)))
        self.flags = flags if flags is not None else staged(ml.outlier_flags(ml.vehicle_features(self.rows, settings), settings))

    @cached_property
    def judged(self) -> DataFrame:
        """Explained verdicts, staged: reports of many vehicles read one table."""
        return staged(self.verdicts())

    @cached_property
    def compared(self) -> tuple[DataFrame, DataFrame]:
        attributes, dets = self.comparisons()
        return staged(attributes), staged(dets)

    def verdicts(self) -> DataFrame:
        records = staged(peers.verdicts(self.flags, self.profiles, self.trips, self.settings))
        return explain.explanations(peers.legacy(peers.with_trips(records, self.trips)), self.settings)

    def fleet_reference(self) -> DataFrame:
        return fleet.reference(self.trips, self.settings)

    def comparisons(self) -> tuple[DataFrame, DataFrame]:
        """Attribute and detector rows of every valid trip against its bucket."""
        matched = staged(fleet.nearest_bucket(self.trips, staged(self.fleet_reference()), self.settings))
        return fleet.attribute_rows(matched), fleet.detector_rows(matched)

    def dashboard(self, charts: bool = True) -> dict[str, DataFrame]:
        """Dashboard tables; without ``charts``, neither statistics, histograms nor maps."""
        drive = staged(sessions.fleet_source_rows(self.rows))
        records = staged(histograms.records(self.flags, drive))
        clusters = histograms.cluster_summary(records)
        out = {"records": records, "clusters": clusters, "totals": histograms.totals(clusters)}
        if not charts:
            return out
        out["vehicle_stats"] = histograms.vehicle_stats(drive)
        for name, keys in (("fleet", ["variant"]), ("vehicle", list(VEHICLE))):
            out[f"{name}_histograms"], out[f"{name}_heatmaps"] = histograms.histograms(drive, keys), histograms.heatmaps(drive, keys)
        return out

    def write(self, out: str, flags: str | None = None, verdicts: str | None = None, summary: str | None = None) -> None:
        """Tables as Parquet, records as JSON lines and as documents, the reference also as CSV.

        ``flags``, ``verdicts`` and ``summary`` name other places of the three documents.
        Flags that the run started from are not written again.
        """
        records = self.judged
        if not self.given_flags:
            write_flags(self.flags, out, self.settings, flags)
        counted = staged(peers.summary_record(records, self.settings))
        facts = {**counted.first().asDict(recursive=True), "params": asdict(self.settings)}
        # The fields of older forms are left to write_older_form.
        documents.write(peers.ordered(records).drop("severity", "strong_metrics", "review_recommendation", "timeline"), verdicts or f"{out}/verdicts_document", summary=facts)
        sinks.write_page(counted.sparkSession, json.dumps(facts, default=str), summary or f"{out}/summary_document")
        sinks.write_table(peers.ordered(records), f"{out}/verdicts")
        sinks.write_json_records(peers.ordered(records), f"{out}/verdicts_json")
        sinks.write_json_records(counted, f"{out}/summary_json")
        reference = staged(self.fleet_reference())
        sinks.write_table(reference, f"{out}/fleet_reference")
        sinks.write_csv(reference, f"{out}/fleet_reference_csv")

    def report(self, imei: str, variant: str | None = None) -> str:
        """HTML report of one vehicle: verdict, trips, deviations, detectors, time in buckets; of each variant the id is in, if none is given."""
        found = self.rows.where(F.col("imei") == imei)
        drawn = reports.pages(self, found.where(F.col("variant") == variant) if variant else found).orderBy("variant").collect()
        if not drawn or all(r.page is None for r in drawn):
            raise LookupError(drawn[0].error if drawn else f"no telemetry of {imei}")
        return "".join(r.page for r in drawn if r.page is not None)

    def write_dashboard(self, out: str, charts: bool = True) -> None:
        """Every dashboard table as Parquet and as JSON lines."""
        for name, table in self.dashboard(charts).items():
            table = staged(table)
            sinks.write_table(table, f"{out}/dashboard/{name}")
            sinks.write_json_records(table, f"{out}/dashboard/{name}_json")

    def reports(self, targets: DataFrame, out: str) -> DataFrame:
        """Pages and index of all targets (variant, imei) in one run; a failed vehicle is a row of the index."""
        return reports.write(self, targets, out)

    def dashboard_page(self) -> str:
        """One page with every verdict; the list view in it is the reader's own filter."""
        return sinks.render(sinks.DASHBOARD, sinks.payload({"version": self.settings.version, "params": asdict(self.settings)}, peers.ordered(self.judged).drop("trips")))


def write_flags(flags: DataFrame, out: str, settings: Settings = DEFAULT, document: str | None = None) -> None:
    """Flags as a table and as a document, which a later run can start from."""
    sinks.write_table(flags, f"{out}/flags")
    documents.write_flags(flags, document or f"{out}/flags_document", settings)


def write_older_form(spark: SparkSession, verdicts: str, out: str, form: str, settings: Settings = DEFAULT, whole: bool = False) -> None:
    """A verdict document as a document of an older form, without running anything again."""
    judged = staged(documents.read(spark, verdicts, whole=whole))
    documents.write(peers.ordered(forms.records(judged, form, settings)), out, **forms.head(judged, form, settings))


def from_csv(spark: SparkSession, path: str, settings: Settings = DEFAULT, keep: str | None = None, flags: DataFrame | None = None) -> Run:
    """A run over CSV telemetry; with ``keep``, a shared folder, cleaned rows and thresholds stay there for later runs; with ``flags``, without the outlier stage."""
    from fleetlens.sources import store, telemetry

    if keep is not None:
        rows, thresholds = store.kept_telemetry(spark, path, keep, settings)
        return Run(rows, settings, flags, thresholds)
    return Run(telemetry.require_rows(telemetry.read_csv(spark, path, settings)), settings, flags)
