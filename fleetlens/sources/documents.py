"""Single JSON documents of many records, written and read by executors.

A document is a folder of text parts that give one JSON object when put together in the
order of their names: a head with the facts of the whole table, then an array of records,
one a line. Nothing but the head passes through the driver, and no task holds all records.

Defined results: an empty table gives an empty array; NULL fields are written; repeated
records stay; a damaged line gives a record of NULLs. A document that another program wrote
as one file is read whole, in one task a file.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlens.config import DEFAULT, Settings
from fleetlens.functions.core import VEHICLE, vehicle_id
from fleetlens.functions.shared import staged
from fleetlens.sources.sinks import JSON_OPTIONS

RECORDS = "vehicles"
# Fields of a vehicle in the document of the outlier stage, in their order.
FLAG_FIELDS = "imei string, variant string, is_anomaly boolean, isolation_score double, distance_to_center double, cluster_id int, severity string, severity_tier int, n_records bigint"


def write(records: DataFrame, path: str, **head) -> None:
    """Writes ``records``, in their order, under ``head``. The head also holds their schema, for reading them back."""
    lines = staged(records.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value")).withColumn("at", F.monotonically_increasing_id()))
    first = lines.agg(F.min("at")).first()[0]
    text = json.dumps({**head, "schema": json.loads(records.schema.json())}, separators=(",", ":"), default=str)
    one = records.sparkSession.range(0, 1, 1, 1)
    comma = F.when(F.col("at") == F.lit(first), F.col("value")).otherwise(F.concat(F.lit(","), F.col("value")))
    parts = one.select(F.lit(f'{text[:-1]},"{RECORDS}":[').alias("value")).union(lines.select(comma.alias("value"))).union(one.select(F.lit("]}").alias("value")))
    parts.write.mode("overwrite").text(path)


def head(spark: SparkSession, path: str) -> dict:
    """The facts of a written document, without its records."""
    line = spark.read.text(path).where(F.col("value").endswith(f'"{RECORDS}":[')).first()
    if line is None:
        raise ValueError(f"{path} is no document of records")
    return json.loads(line.value + "]}")


def read(spark: SparkSession, path: str, schema: StructType | str | None = None, whole: bool = False) -> DataFrame:
    """Records of a document, with the schema in its head unless one is given; ``whole`` for a file of another program."""
    if whole:
        found = spark.read.option("multiLine", True)
        if schema is not None:
            record = schema if isinstance(schema, str) else schema.simpleString()[len("struct<") : -1]
            found = found.schema(f"{RECORDS} array<struct<{record}>>")
        return found.json(path).select(F.explode(RECORDS).alias("r")).select("r.*")
    schema = schema if schema is not None else StructType.fromJson(head(spark, path)["schema"])
    value = F.col("value")
    line = spark.read.text(path).where((value != "]}") & ~value.endswith(f'"{RECORDS}":['))
    return line.select(F.from_json(F.ltrim(value, F.lit(",")), schema).alias("r")).select("r.*")


def write_flags(flags: DataFrame, path: str, settings: Settings = DEFAULT) -> None:
    """The document of the outlier stage, by variant and id."""
    fields = [f.split()[0] for f in FLAG_FIELDS.split(", ")]
    found = staged(flags.select(*fields))
    counts = found.agg(F.count("*").alias("n_vehicles"), F.count_if("is_anomaly").alias("n_anomalies")).first().asDict()
    write(found.orderBy(*VEHICLE), path, pipeline_version=settings.version, stage="stage1", **counts)


def read_flags(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Flags of a document of the outlier stage. Ids are normalised; its two single outlier marks are not in it and come back as NULL."""
    found = read(spark, path, FLAG_FIELDS, whole).withColumns({"imei": vehicle_id(F.col("imei")), "is_anomaly": F.coalesce("is_anomaly", F.lit(False))})
    return found.where("imei is not null and variant is not null").withColumns({c: F.lit(None).cast("boolean") for c in ("cluster_outlier", "isolation_outlier")})
