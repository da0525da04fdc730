"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every contract: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: The operator that this worker process served last, and what drops the tables it keeps between tasks.
_served: list = ["", None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only in local mode (tests, notebooks) may it be unset; a folder of our own is set then.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="fleetlens-shared-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder of the session."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and its path.

    For loops: a checkpoint keeps the size that the optimizer estimated, and estimates of
    joins multiply from turn to turn; a written table has the size of its files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a written table, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def serving(operator: str, drop: Callable[[], None] | None = None) -> None:
    """Called by a Python task as it begins, since Spark reuses a worker process for all operators.

    Where the worker served another operator before, what that one keeps between tasks
    (vocabularies, remembered hashes) goes. Free memory returns to the system.
    """
    import pyarrow as pa

    if _served[0] != operator:
        if _served[1] is not None:
            _served[1]()
        _served[:] = [operator, drop]
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def words(text: Column) -> Column:
    """Words of a text; no empty strings. NULL text gives no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def key_text(key: Column) -> Column:
    """A record key as text; NULL keys share one value no number can print as."""
    return F.coalesce(key.cast("string"), F.lit("\\N"))
