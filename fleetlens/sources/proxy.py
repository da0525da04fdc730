"""Proxy telemetry over the order-line table, for queries that SQL can check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.functions.core import VEHICLE
from fleetlens.functions.shared import bucketed


#: Rows of a bucket in the mean, and buckets at least and at most.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 150_000, 8, 50_000


def bucketed_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``telemetry``, shuffled by vehicle once and written in buckets of vehicles.

    Their number follows the rows of the input, so a task sorts as many rows in a large
    table as in a small one. A vehicle is in one bucket, as it is in one task of ``telemetry``.
    """
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)))
    return bucketed(telemetry(spark, sf_dir, buckets), buckets, VEHICLE)


def telemetry(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Clean telemetry columns; one row an order line, days apart.

    One shuffle by vehicle serves the row number and the running odometer, and the
    session windows of later operators reuse it. It has ``partitions`` if they are given.
    """
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("variant", F.col("l_returnflag")).withColumn("imei", F.col("l_suppkey").cast("string"))
    if partitions:
        line = line.repartition(partitions, *VEHICLE)
    w = Window.partitionBy(*VEHICLE).orderBy(*order)
    return (
        line.withColumn("seq", F.row_number().over(w).cast("long"))
        .withColumn("odometer", F.sum("l_quantity").over(w.rowsBetween(Window.unboundedPreceding, 0)) * 0.5)
        .select(
            "variant",
            "imei",
            F.col("l_shipdate").alias("time"),
            "seq",
            "odometer",
            (F.col("l_extendedprice") / 10).alias("rpm"),
            (F.col("l_discount") * 1000).alias("torque"),
            F.col("l_quantity").alias("speed"),
            (F.col("l_tax") * 1000).alias("throttle"),
            (F.col("l_extendedprice") / 200).alias("current"),
            (F.lit(20) + F.col("l_partkey") % 61).cast("double").alias("temp"),
            (F.lit(100) - F.col("seq") % 90).cast("double").alias("soc"),
            F.when(F.col("l_linestatus") == "F", 2).otherwise(1).cast("short").alias("state"),
            (F.col("l_partkey") % 3).cast("short").alias("mode"),
        )
    )


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy text telemetry over the same table, for the cleaning rules."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "case l_linenumber % 6 when 0 then concat(l_suppkey, '.0') when 1 then concat(' ', l_suppkey, ' ') when 2 then 'NaN' when 3 then concat('ID-', l_suppkey) when 4 then '' else cast(l_suppkey as string) end as imei",
        "if(l_orderkey % 17 = 0, 'not a time', date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')) as time",
        "if(l_partkey % 19 = 0, null, l_returnflag) as vehicle_model_name",
        "l_linestatus as vehicle_variant_name",
        "case when l_partkey % 7 = 0 then 'bad' when l_partkey % 11 = 0 then 'NaN' when l_partkey % 13 = 0 then 'Infinity' else cast(cast(l_quantity as int) as string) end as speed",
        "cast(cast(l_quantity as int) as string) as rpm",
        "cast(cast(l_quantity as int) as string) as torque",
        "cast(cast(l_quantity as int) as string) as throttle",
        "cast(cast(l_quantity as int) as string) as current",
        "cast(cast(l_quantity as int) as string) as odometer",
        "cast(cast(l_quantity as int) as string) as controllerTemperature",
        "if(l_linenumber % 2 = 0, '0.5', '1') as soc",
        "case l_linenumber % 3 when 0 then '2' when 1 then '1.0' else '1.5' end as vehicleState",
        "if(l_linenumber % 2 = 0, '0', 'x') as controllerControllerMode",
        "l_orderkey * 8 + l_linenumber as seq",
    )


def injected_flags(spark: SparkSession, sf_dir: str, vehicles: DataFrame) -> DataFrame:
    """A stand-in for the outlier stage: flags, scores and clusters from the supplier table."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").cast("string").alias("imei"),
        (F.col("s_acctbal") < 2000).alias("cluster_outlier"),
        (F.col("s_acctbal") < 500).alias("isolation_outlier"),
        (F.col("s_acctbal") / 100).alias("isolation_score"),
        (F.abs(F.col("s_acctbal")) / 100).alias("distance_to_center"),
        (F.col("s_nationkey") % 2).cast("int").alias("cluster_id"),
    )
    tier = F.col("cluster_outlier").cast("int") + F.col("isolation_outlier").cast("int")
    return (
        vehicles.select("variant", "imei", "n_records")
        .join(supplier, "imei")
        .withColumn("is_anomaly", F.col("cluster_outlier") | F.col("isolation_outlier"))
        .withColumn("severity_tier", tier)
        .withColumn("severity", F.when(tier >= 2, "HIGH").when(tier == 1, "MEDIUM").otherwise("NORMAL"))
    )
