"""Telemetry readers: wide CSV or Parquet to the clean schema."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.config import DEFAULT, Settings
from fleetlens.functions.core import number, small_integer, vehicle_id

NUMBERS = {"odometer": "odometer", "rpm": "rpm", "torque": "torque", "speed": "speed", "throttle": "throttle", "current": "current", "controllerTemperature": "temp", "soc": "soc"}
INTEGERS = {"vehicleState": "state", "controllerControllerMode": "mode"}
RAW = ("time", "imei", "vehicle_model_name", "vehicle_variant_name", *NUMBERS, *INTEGERS)
CLEAN = ("variant", "imei", "time", "seq", *NUMBERS.values(), *INTEGERS.values())


def clean(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Raw text columns to the clean schema.

    Rows without model, variant, id or time go. ``seq`` orders rows of equal time:
    a given ``seq`` column, else a hash of the row, so it is the same on every read.
    """
    rows = raw.na.drop(subset=["vehicle_model_name", "vehicle_variant_name"])
    if settings.models is not None:
        rows = rows.where(F.col("vehicle_model_name").isin(*settings.models))
    seq = F.col("seq") if "seq" in raw.columns else F.xxhash64(*RAW)
    rows = rows.select(
        F.concat_ws(" | ", "vehicle_model_name", "vehicle_variant_name").alias("variant"),
        vehicle_id(F.col("imei")).alias("imei"),
        F.try_to_timestamp(F.col("time").cast("string")).alias("time"),
        seq.cast("long").alias("seq"),
        *[number(F.col(c)).alias(n) for c, n in NUMBERS.items()],
        *[small_integer(F.col(c)).alias(n) for c, n in INTEGERS.items()],
    )
    return rescale_soc(rows.where("imei is not null and time is not null"))


def rescale_soc(rows: DataFrame) -> DataFrame:
    """State of charge in per cent: times 100 where the whole fleet's maximum is 1.5 or less."""
    top = rows.agg(F.max("soc").alias("soc_top"))
    return rows.crossJoin(F.broadcast(top)).withColumn("soc", F.when(F.col("soc_top") <= 1.5, F.col("soc") * 100).otherwise(F.col("soc"))).drop("soc_top")


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of one CSV file, compressed or not, in whatever store it is."""
    java = spark._jvm
    settings, at = spark._jsc.hadoopConfiguration(), java.org.apache.hadoop.fs.Path(file)
    stream = at.getFileSystem(settings).open(at)
    try:
        codec = java.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(at)
        source = stream if codec is None else codec.createInputStream(stream)
        line = java.java.io.BufferedReader(java.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(name.strip() for name in next(csv.reader([(line or "").removeprefix("\ufeff")]), ()))


def read_csv(spark: SparkSession, path: str, settings: Settings = DEFAULT) -> DataFrame:
    """Clean telemetry of a CSV file or folder with headers; only named columns are parsed.

    Columns go by the header of each file: files with the same header are one scan, and
    scans are united by name. A file without one of the columns is an error that names both;
    an empty file has no rows.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in spark.read.text(path).inputFiles():
        if header := header_of(spark, file):
            groups.setdefault(header, []).append(file)
            if missing := [c for c in RAW if c not in header]:
                raise ValueError(f"{file} has no column {', '.join(missing)}")
    parts = []
    for header, files in sorted(groups.items()):
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        names = [F.col(f"c{header.index(c)}").alias(c) for c in RAW]
        parts.append(spark.read.schema(schema).option("header", True).csv(files).select(*names))
    none = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in RAW]))
    return clean(reduce(DataFrame.unionByName, parts) if parts else none, settings)


def read_parquet(spark: SparkSession, path: str, settings: Settings = DEFAULT) -> DataFrame:
    return clean(spark.read.parquet(path).select(*RAW), settings)


def require_rows(rows: DataFrame, scope: str = "any model") -> DataFrame:
    """For command lines: an error where no telemetry is left."""
    if rows.isEmpty():
        raise ValueError(f"no telemetry rows for {scope}")
    return rows
