"""Staging of intermediate tables that several branches of a plan read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a staged side of a join is broadcast.
BROADCAST_ROWS = 100_000


def shared_folder(df: DataFrame) -> str:
    """The folder of checkpoints: the session's ``spark.checkpoint.dir``; one of our own only in local mode where that is unset, as in tests."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="fleetlens-"))
    return context.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: computed once, survives lost executors, and keeps plans short."""
    shared_folder(df)
    return df.checkpoint(eager=True)


def tabled(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back, for long tables of numbers.

    Columns compress, and a reader takes only the ones it needs, so it is a fraction of a checkpoint.
    """
    path = f"{shared_folder(df)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, buckets: int, by: tuple[str, ...]) -> DataFrame:
    """As ``tabled``, in ``buckets`` files by ``by``: joins, windows and groups of keys with these columns shuffle no rows.

    ``df`` lies in as many partitions by the same columns, so a task writes one file.
    """
    name = f"table_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", f"{shared_folder(df)}/{name}").bucketBy(buckets, *by).saveAsTable(name)
    return df.sparkSession.table(name)


def small(df: DataFrame, of: DataFrame | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table, or a projection ``of`` it with no more rows, with a broadcast hint where a count shows that it is small."""
    out = df if of is None else of
    return F.broadcast(out) if df.limit(most + 1).count() <= most else out
