"""Cleaned telemetry and its thresholds kept between runs, by the files and settings they come from.

The key of a kept table is a digest of path, length and modification time of every input
file and of all settings, so a changed file or setting gives another table and never an
old one. Rows are bucketed by vehicle and slice of time: a second run reads no CSV and
numbers sessions without shuffling the rows, and an id on a third of all rows is spread
over buckets. A table counts once its folder has the mark of a finished write. Tables of
earlier inputs stay until they are removed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, Settings
from fleetlens.functions.core import VEHICLE
from fleetlens.operators.detectors import variant_thresholds
from fleetlens.operators.sessions import sliced
from fleetlens.sources import telemetry

#: Raised when cleaning or layout changes, so that tables of older code are not read.
LAYOUT = 1
BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 50_000


def fingerprint(spark: SparkSession, path: str, settings: Settings = DEFAULT) -> tuple[str, int]:
    """Digest of the input files (their names, sizes and times, not their contents) and settings, and their bytes."""
    files = spark.read.format("binaryFile").load(path)
    mixed = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    n, size, total, xored = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.sum(mixed.cast("decimal(38,0)")), F.bit_xor(mixed)).first()
    said = repr((LAYOUT, n, size, total, xored, settings))
    return hashlib.sha256(said.encode()).hexdigest()[:32], size


def _finished(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def kept(spark: SparkSession, store: str, name: str, build: Callable[[], DataFrame], buckets: int = 0, by: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> DataFrame:
    """The table ``name`` of the store; built and written first if no finished write of it is there."""
    path = f"{store}/{name}"
    if not _finished(spark, path):
        rows = build()
        if buckets:
            rows = rows.repartition(buckets, *by)
        writer = rows.write.format("parquet").mode("overwrite").option("path", path)
        (writer.bucketBy(buckets, *by).sortBy(*order) if buckets else writer).saveAsTable(name)
    elif not spark.catalog.tableExists(name):
        # A later session, whose catalog may not know the table yet.
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        layout = f"CLUSTERED BY ({', '.join(by)}) SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS" if buckets else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet {layout} LOCATION '{path}'")
    return spark.table(name)


def kept_telemetry(spark: SparkSession, path: str, store: str, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Clean telemetry with its slices, and variant thresholds, of a CSV file or folder."""
    key, size = fingerprint(spark, path, settings)
    # From the input alone, so that a later session declares the same layout.
    buckets = min(MOST_BUCKETS, max(64, math.ceil(size / BUCKET_BYTES)))
    rows = kept(spark, store, f"telemetry_{key}", lambda: sliced(telemetry.require_rows(telemetry.read_csv(spark, path, settings)), settings), buckets, (*VEHICLE, "slice"), (*VEHICLE, "slice", "time", "seq"))
    return rows, kept(spark, store, f"thresholds_{key}", lambda: variant_thresholds(rows, settings))
