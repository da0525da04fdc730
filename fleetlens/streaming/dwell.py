"""Sustained contradictions on a stream: one row for each finished run of a detector.

Runs follow the batch rules of ``dwell_runs``: adjacent true rows of a trip or charge
session in order of (time, seq). Masks are worked out by the JVM; the state of a
(vehicle, kind of unit) holds the rows that the watermark has not passed and one open run
a detector, so it is bounded by the lateness and not by the stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens.config import CHARGE, DEFAULT, RUN, Settings
from fleetlens.functions.core import VEHICLE, micros
from fleetlens.operators.detectors import CHARGE_MASK, RUN_MASKS

KEY = [*VEHICLE, "kind"]
MASKS = {"drive": RUN_MASKS, "charge": {"d7_charge_overtaper": CHARGE_MASK}}
FOUND = "variant string, imei string, det string, unit_at long, run long, first_at long, last_at long"


class _Runs(StatefulProcessor):
    """Waits for the watermark, then takes rows in order; timers are those of rows to come and of the gap that ends a unit."""

    def __init__(self, gap_us: int, dwell: dict[str, int], names: dict[str, list[str]]):
        self.gap_us, self.dwell, self.names = gap_us, dwell, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, seq long, hits long")
        self.unit = handle.getValueState("unit", "began long, ended long")
        self.runs = handle.getMapState("runs", "det string", "first long, last long, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        latest = 0
        for frame in rows:
            self.waiting.appendList([(int(a), int(s), int(h)) for a, s, h in zip(frame["at"], frame["seq"], frame["hits"], strict=True)])
            latest = max(latest, int(frame["at"].max()))
        # Rounded up to milliseconds: the row itself has then been passed.
        self.handle.registerTimer(-(-latest // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        ready = [r for r in waiting if r[0] <= passed]
        if ready:
            later = waiting[len(ready) :]
            self.waiting.clear()
            if later:
                self.waiting.put(later)
        began, ended = self.unit.get() if self.unit.exists() else (None, None)
        runs = {k[0]: tuple(v) for k, v in self.runs.iterator()} if self.runs.exists() else {}
        names, done = self.names[key[2]], []

        def close(dets):
            for det in dets:
                first, last, n = runs.pop(det)
                if n >= self.dwell[det]:
                    done.append((key[0], key[1], det, began, n, first, last))

        for at, _, hits in ready:
            if ended is None or at - ended > self.gap_us:
                close(list(runs))
                began = at
            ended = at
            for i, det in enumerate(names):
                if hits >> i & 1:
                    first, _, n = runs.get(det, (at, at, 0))
                    runs[det] = (first, at, n + 1)
                elif det in runs:
                    close([det])
        over = ended is not None and ended + self.gap_us <= passed
        if over:
            close(list(runs))
        self.runs.clear()
        for det, run in runs.items():
            self.runs.updateValue((det,), run)
        if over:
            self.unit.clear()
        elif ready:
            self.unit.update((began, ended))
            self.handle.registerTimer(-(-(ended + self.gap_us) // 1000))
        if done:
            yield pd.DataFrame(done, columns=[c.split()[0] for c in FOUND.split(", ")])


def streaming_runs(rows: DataFrame, thresholds: DataFrame, settings: Settings = DEFAULT, late: str = "15 minutes") -> DataFrame:
    """Runs of all eight detectors on a stream of clean telemetry, each once it has ended and the watermark has passed.

    Columns: variant, imei, det, unit_time (first row of the trip or charge session), run
    (rows), dwell_s, first_time, last_time. ``thresholds`` is a table of one row a variant
    (``variant_thresholds`` of past telemetry). Rows later than the watermark of the
    batch before are dropped, so they break and lengthen no run. Runs below the dwell of their detector are not
    returned. The query needs the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    kind = F.when((F.col("state") == RUN) & (F.col("speed") > 0), "drive").when(F.col("state") == CHARGE, "charge")
    bits = {k: sum((F.when(F.expr(m), F.lit(1 << i)).otherwise(F.lit(0)) for i, m in enumerate(masks.values())), F.lit(0)).cast("long") for k, masks in MASKS.items()}
    ready = (
        rows.withWatermark("time", late)
        .withColumn("kind", kind)
        .where("kind is not null")
        .join(thresholds, "variant", "left")
        .select(*KEY, "time", micros("time").alias("at"), "seq", F.when(F.col("kind") == "drive", bits["drive"]).otherwise(bits["charge"]).alias("hits"))
    )
    runs = _Runs(int(settings.trip_gap * settings.unit_s * 1e6), dict(settings.dwell), {k: list(m) for k, m in MASKS.items()})
    found = ready.groupBy(*KEY).transformWithStateInPandas(runs, FOUND, "Append", "EventTime")
    return found.select(
        *VEHICLE,
        "det",
        F.timestamp_micros("unit_at").alias("unit_time"),
        "run",
        (F.col("run") * F.lit(settings.row_seconds)).alias("dwell_s"),
        F.timestamp_micros("first_at").alias("first_time"),
        F.timestamp_micros("last_at").alias("last_time"),
    )
