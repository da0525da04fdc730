"""Places of rows in a sorted table, without a window over the whole of it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.shared import staged

#: Bits that ``monotonically_increasing_id`` keeps for the rows of one partition.
_ROW_BITS = 33


def positioned(ordered: DataFrame, name: str = "position") -> DataFrame:
    """``ordered``, the result of an ``orderBy``, with the place of each row from 1.

    A sort deals rows into ranges, so a place is the number of rows in the ranges before,
    and the row's own number in its range. The driver sees one count a partition. Rows
    that the order leaves equal have places in no fixed order; an empty table has none.
    """
    rows = staged(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    counts = sorted((r.part, r.n) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = dict(zip((p for p, _ in counts), accumulate((n for _, n in counts), initial=0)))
    offset = F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv])[part] if before else F.lit(0)
    return rows.withColumn(name, (offset + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1) + 1).cast("long")).drop("_at")
