"""Vehicle reports as one job: every page, or the reason why there is none, is a row."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.core import VEHICLE
from fleetlens.functions.shared import small, staged
from fleetlens.operators import fleet, sessions
from fleetlens.sources import sinks

if TYPE_CHECKING:
    from fleetlens.plans.pipeline import Run

#: What the index says of a vehicle.
FACTS = ("verdict", "strong_metric_count", "n_trips", "n_peers", "reason")
Render = Callable[[str, str, list[tuple[str, list[dict]]]], str]


def page_of(variant: str, imei: str, sections: list[tuple[str, list[dict]]]) -> str:
    """The page of one vehicle from its sections (title, rows)."""
    return sinks.page(f"Vehicle {imei} ({variant})", [sinks.html_rows(title, rows) for title, rows in sections])


def _section(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """(variant, imei, name): the vehicle's rows as JSON texts, in order; bounded by one vehicle's history."""
    rest = [c for c in df.columns if c not in VEHICLE]
    row = F.struct(*order, F.to_json(F.struct(*rest), sinks.JSON_OPTIONS).alias("row"))
    return df.groupBy(*VEHICLE).agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["row"]).alias(name))


def pages(run: Run, targets: DataFrame, render: Render = page_of) -> DataFrame:
    """(variant, imei, facts, page, error) of every target (variant, imei).

    A fixed number of jobs for any number of vehicles: each section is one aggregate by
    vehicle over the targets' rows, and executors draw the pages. A vehicle that fails is
    a row with an error; the others are not touched.
    """
    targets = staged(targets.select(*VEHICLE).distinct())
    ours = lambda df: df.join(small(targets), list(VEHICLE), "left_semi")
    attributes, dets = run.compared
    judged, mine = ours(run.judged), staged(ours(run.trips))
    moving = staged(sessions.trips_of(ours(run.rows), run.settings))
    judgement = judged.select(*VEHICLE, "verdict", "watch_reason", "n_trips", "n_peers", F.array_join("explanations", " ").alias("account"))
    parts = [
        ("Verdict", judgement, []),
        ("Averages", fleet.attribute_means(mine), []),
        ("Range", fleet.vehicle_range(mine), []),
        ("Deviations", ours(attributes), ["trip_id", "attr"]),
        ("Detectors", fleet.detector_rollup(ours(dets)), ["det"]),
        ("Time in buckets, all trips", fleet.time_in_buckets(fleet.elevated_rows(moving, mine, False), list(VEHICLE)), ["signal", "bucket"]),
        ("Time in buckets, elevated trips", fleet.time_in_buckets(fleet.elevated_rows(moving, mine), list(VEHICLE)), ["signal", "bucket"]),
    ]
    titles = [title for title, _, _ in parts]
    whole = targets.join(judged.select(*VEHICLE, *FACTS), list(VEHICLE), "left")
    for i, (_, df, order) in enumerate(parts):
        whole = whole.join(_section(df, f"s{i}", order), list(VEHICLE), "left")
    schema = "variant string, imei string, page string, error string"

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                try:
                    found = [(title, [json.loads(x) for x in r[f"s{i}"]] if r[f"s{i}"] is not None else []) for i, title in enumerate(titles)]
                    if not found[0][1]:
                        raise LookupError("no verdict: no valid trip, or an unknown vehicle")
                    rows.append((r["variant"], r["imei"], render(r["variant"], r["imei"], found), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((r["variant"], r["imei"], None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(rows, columns=["variant", "imei", "page", "error"])

    whole = staged(whole)
    drawn = whole.select(*VEHICLE, *[f"s{i}" for i in range(len(parts))]).mapInPandas(draw, schema)
    return whole.select(*VEHICLE, *FACTS).join(drawn, list(VEHICLE))


def write(run: Run, targets: DataFrame, out: str, render: Render = page_of) -> DataFrame:
    """Pages by variant and vehicle under ``out``/pages, the index table and its page; returns the index.

    Executors write, so ``out`` may be in any store that Spark writes to.
    """
    drawn = staged(pages(run, targets, render))
    drawn.where("page is not null").select(*VEHICLE, "page").repartition(*VEHICLE).write.mode("overwrite").partitionBy(*VEHICLE).text(f"{out}/pages")
    index = drawn.select(*VEHICLE, *FACTS, "error").orderBy(F.desc_nulls_last("strong_metric_count"), *VEHICLE)
    sinks.write_json_records(index, f"{out}/index_json")
    sinks.write_page(drawn.sparkSession, sinks.index_page(index), f"{out}/index")
    return index
