"""Row filters, gap sessions and dwell runs.

Rows are in time order with ``seq`` as the tiebreak, so results do not depend on
partitioning. Unless the rows lie by vehicle already, no window spans all rows of one: rows are numbered within slices of
time, and a row for each vehicle and slice carries numbers and gaps over the edges. A
placeholder id on a third of all rows is thus as many tasks as it has slices. Readers
have dropped rows without variant, imei or time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import CHARGE, DEFAULT, RUN, Settings
from fleetlens.functions.core import VEHICLE, micros


def driving(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("state") == RUN)


def moving(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("state") == RUN) & (F.col("speed") > 0))


def charging(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("state") == CHARGE)


def ratio_rows(rows: DataFrame) -> DataFrame:
    return rows.where("speed > 3 and rpm > 50").withColumn("rpm_per_speed", F.col("rpm") / F.col("speed"))


def source_rows(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Driving rows of variants with enough of them, else all rows of the variant."""
    counted = rows.groupBy("variant").agg(F.count_if(F.col("state") == RUN).alias("drives"))
    return rows.join(counted, "variant").where((F.col("state") == RUN) | (F.col("drives") < settings.min_drive_rows)).drop("drives")


def fleet_source_rows(rows: DataFrame) -> DataFrame:
    """Driving rows; all rows where the fleet has no driving row at all."""
    total = rows.agg(F.count_if(F.col("state") == RUN).alias("drives"))
    return rows.crossJoin(F.broadcast(total)).where((F.col("state") == RUN) | (F.col("drives") == 0)).drop("drives")


def sliced(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Rows with their ``slice`` of time; kept telemetry brings it along."""
    if "slice" in rows.columns:
        return rows
    wide = int(settings.slice_gaps * settings.trip_gap * settings.unit_s * 1e6)
    return rows.withColumn("slice", F.floor(micros("time") / F.lit(wide)))


def _numbered(rows: DataFrame, settings: Settings, name: str, first: int) -> DataFrame:
    """Adds to each row of its vehicle, over all slices of time:

    ``gap``, time units since the row before; ``name``, the session number from ``first``,
    a gap over the limit starting the next; ``place``, the row's number from 1; ``slice``
    with the places of its first and last row, ``slice_first`` and ``slice_last``.
    """
    units = F.lit(1e6 * settings.unit_s)
    breaks = lambda gap: F.when(gap > settings.trip_gap, 1).otherwise(0)
    rows = sliced(rows, settings)
    key = [*VEHICLE, "slice"]
    # Gaps do not depend on the order of equal times, so this pass reads times alone.
    inside = (micros("time") - F.lag(micros("time")).over(Window.partitionBy(*key).orderBy("time"))) / units
    ends = (
        rows.select(*key, "time", inside.alias("gap"))
        .groupBy(*key)
        .agg(F.count("*").alias("n"), F.sum(breaks(F.col("gap"))).alias("breaks"), F.min(micros("time")).alias("began"), F.max(micros("time")).alias("ended"))
    )
    by_slice = Window.partitionBy(*VEHICLE).orderBy("slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        ends.withColumn("_before", F.lag("ended").over(by_slice))
        .withColumn("breaks", F.col("breaks") + breaks((F.col("began") - F.col("_before")) / units))
        .select(
            *key,
            "_before",
            # The gap into this slice is counted by its first row, so only earlier slices count here.
            (F.coalesce(F.sum("breaks").over(earlier), F.lit(0)) + first).alias("_number"),
            (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1).alias("slice_first"),
            F.sum("n").over(by_slice).alias("slice_last"),
        )
    )
    w = Window.partitionBy(*key).orderBy("time", "seq")
    return (
        rows.join(stitched, key)
        .withColumn("gap", (micros("time") - F.coalesce(F.lag(micros("time")).over(w), F.col("_before"))) / units)
        .withColumn(name, (F.col("_number") + F.sum(breaks(F.col("gap"))).over(w)).cast("int"))
        .withColumn("place", F.col("slice_first") + F.row_number().over(w) - 1)
        .drop("_before", "_number")
    )


def _numbered_whole(rows: DataFrame, settings: Settings, name: str, first: int) -> DataFrame:
    """As ``_numbered``, each vehicle in one window and one slice, whose edges are never open."""
    w = Window.partitionBy(*VEHICLE).orderBy("time", "seq")
    gap = (micros("time") - F.lag(micros("time")).over(w)) / F.lit(1e6 * settings.unit_s)
    starts = F.sum(F.when(F.col("gap") > settings.trip_gap, 1).otherwise(0)).over(w)
    edge = F.lit(None).cast("long")
    return rows.withColumn("gap", gap).withColumns({name: (first + starts).cast("int"), "place": F.row_number().over(w), "slice": F.lit(0), "slice_first": edge, "slice_last": edge})


def trips_of(rows: DataFrame, settings: Settings = DEFAULT, whole: bool = False) -> DataFrame:
    """Moving rows with ``trip_id`` from 0; a gap over the limit starts a trip.

    ``whole``: rows lie by vehicle, so that a window over each shuffles none of them.
    """
    return (_numbered_whole if whole else _numbered)(moving(rows), settings, "trip_id", 0)


def charge_sessions_of(rows: DataFrame, settings: Settings = DEFAULT, whole: bool = False) -> DataFrame:
    """Charging rows with ``session_id`` from 1; ``whole`` as in ``trips_of``."""
    return (_numbered_whole if whole else _numbered)(charging(rows), settings, "session_id", 1)


def gap_sessions(rows: DataFrame, key: str, time: str, gap_s: float, tie: str) -> DataFrame:
    """Plain form for any event table: ``session_id`` from 0 for each key."""
    w = Window.partitionBy(key).orderBy(time, tie)
    gap = (micros(time) - F.lag(micros(time)).over(w)) / 1e6
    return rows.withColumn("_gap", gap).withColumn("session_id", F.sum(F.when(F.col("_gap") > gap_s, 1).otherwise(0)).over(w).cast("int")).drop("_gap")


def dwell_runs(rows: DataFrame, unit: list[str], dwell: dict[str, int], row_seconds: float, mask: str = "hit", det: str = "det") -> DataFrame:
    """Runs of adjacent true rows within a unit: events, longest and mean dwell for each detector.

    ``rows`` has one row for each sample and detector, with ``place`` rising by one from
    sample to sample of a unit. A run ends at a true sample whose next one is not adjacent,
    and began at the last one whose previous one was not: both are read in the order of the
    window, so no table of runs is held. Runs shorter than the detector's dwell do not count.
    Where rows have slices, runs are found inside them; a run that touches the edge of
    its slice stays open, at most two a slice, and open runs of adjacent places are one.
    """
    if "slice" not in rows.columns:
        rows = rows.withColumns({"slice": F.lit(0), "slice_first": F.lit(None).cast("long"), "slice_last": F.lit(None).cast("long")})
    w = Window.partitionBy(*unit, det, "slice").orderBy("place")
    least = F.element_at(F.create_map(*[F.lit(x) for kv in dwell.items() for x in kv]), F.col(det))
    at = F.col("place")
    starts = F.coalesce(at - F.lag(at).over(w) > 1, F.lit(True))
    ends = F.coalesce(F.lead(at).over(w) - at > 1, F.lit(True))
    runs = (
        rows.where(mask)
        .withColumns({"begins": F.when(starts, at), "ends": ends})
        .withColumn("first", F.max("begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .where("ends")
        .withColumns({"last": at, "run": at - F.col("first") + 1})
        .withColumn("open", F.coalesce((F.col("first") == F.col("slice_first")) | (F.col("last") == F.col("slice_last")), F.lit(False)))
        .where(F.col("open") | (F.col("run") >= least))
    )
    done = F.when(~F.col("open"), F.col("run"))
    units = runs.groupBy(*unit, det).agg(
        F.count(done).alias("events"), F.max(done).alias("longest"), F.sum(done).alias("total"), F.sort_array(F.collect_list(F.when(F.col("open"), F.struct("first", "last")))).alias("open")
    )
    begin = "filter(open, (x, i) -> i = 0 or get(open, i - 1).last + 1 < x.first)"
    end = "filter(open, (x, i) -> i = size(open) - 1 or get(open, i + 1).first > x.last + 1)"
    joined = F.filter(F.expr(f"zip_with({begin}, {end}, (a, b) -> b.last - a.first + 1)"), lambda n: n >= least)
    return (
        units.withColumn("joined", joined)
        .withColumn("events", F.col("events") + F.size("joined"))
        .where("events > 0")
        .select(
            *unit,
            det,
            "events",
            (F.greatest("longest", F.array_max("joined")) * F.lit(row_seconds)).alias("max_dwell_s"),
            ((F.coalesce("total", F.lit(0)) + F.expr("aggregate(joined, 0L, (a, n) -> a + n)")) * F.lit(row_seconds) / F.col("events")).alias("mean_dwell_s"),
        )
    )
