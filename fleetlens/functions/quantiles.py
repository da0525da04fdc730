"""Exact percentiles of groups of any size, without a shuffle of their values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.shared import small, staged

#: A sketch gives a value whose rank is off by a share of 1 / ACCURACY of the group at most.
ACCURACY = 10_000
#: Share of a group on each side of a wanted rank that its bracket takes in.
REACH = 2.0 / ACCURACY


@dataclass(frozen=True)
class Wanted:
    """Percentiles of one column: the result's name, the values and the shares."""

    name: str
    value: Column
    shares: Sequence[float]


def between(rank: Column, low: Column, high: Column) -> Column:
    """Linear interpolation at a fractional rank, from the values at its floor and ceiling."""
    return F.when(F.floor(rank) == F.ceil(rank), low).otherwise((F.ceil(rank) - rank) * low + (rank - F.floor(rank)) * high)


def exact_percentiles(rows: DataFrame, keys: list[str], wanted: Sequence[Wanted]) -> DataFrame:
    """(keys, name: array of interpolated percentiles) for each group; NULL for a group without values.

    Two scans of ``rows``, which should be cheap to read again. The first merges quantile
    sketches; they bracket every wanted rank between two values. The second counts: values
    inside a bracket by value, all values of a gap between brackets as one. The counts are
    partial before the shuffle, so a group of a third of all rows shuffles some four values in
    ACCURACY for each wanted rank, and ranks are running sums of the counts. A rank that falls
    into a gap, which the sketch's bound rules out, is looked up again among all values.
    """
    columns = rows.select(*keys, *[w.value.cast("double").alias(f"v{i}") for i, w in enumerate(wanted)])
    ends = lambda w: F.array(*[F.lit(min(1.0, max(0.0, p + side))) for p in sorted(w.shares) for side in (-REACH, REACH)])
    sketched = columns.groupBy(*keys).agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(wanted))],
        *[F.percentile_approx(f"v{i}", ends(w), ACCURACY).alias(f"e{i}") for i, w in enumerate(wanted)],
    )
    stack = lambda *parts: F.expr(f"stack({len(wanted)}, {', '.join(f'{i}, ' + ', '.join(p.format(i=i) for p in parts) for i in range(len(wanted)))})")
    known = staged(sketched.select(*keys, stack("n{i}", "e{i}").alias("which", "total", "ends")))
    most = max(len(w.shares) for w in wanted)
    edges = [F.get("ends", F.lit(2 * k + side)).alias(f"{name}{k}") for k in range(most) for side, name in ((0, "from"), (1, "to"))]
    asked = small(known, known.where("total > 0").select(*keys, "which", "total", *edges))
    long = columns.select(*keys, stack("v{i}").alias("which", "value")).where("value is not null")
    # The first bracket that does not end before the value: the value is inside it, or in the gap before it.
    cell = inside = None
    for k in range(most):
        here = F.col("value") <= F.col(f"to{k}")
        start = F.col(f"from{k}")
        cell = F.when(here, F.greatest("value", start)) if cell is None else cell.when(here, F.greatest("value", start))
        inside = F.when(here, F.col("value") >= start) if inside is None else inside.when(here, F.col("value") >= start)
    counted = (
        long.join(asked, [*keys, "which"])
        .select(*keys, "which", cell.otherwise(float("inf")).alias("value"), inside.otherwise(False).alias("inside"))
        .groupBy(*keys, "which", "value", "inside")
        .agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy(*keys, "which").orderBy("value", "inside").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("last", F.sum("n").over(order) - 1).join(asked.select(*keys, "which", "total"), [*keys, "which"])
    shares = F.element_at(F.create_map(*[F.lit(x) for i, w in enumerate(wanted) for x in (i, list(map(float, w.shares)))]), F.col("which"))
    spots = ranked.select(*keys, "which", "value", "inside", "last", "n", F.posexplode(F.transform(shares, lambda p: p * (F.col("total") - 1))).alias("spot", "rank"))
    at = lambda rank: F.max(F.when((rank <= F.col("last")) & (rank > F.col("last") - F.col("n")) & F.col("inside"), F.col("value")))
    picked = spots.groupBy(*keys, "which", "spot").agg(F.first("rank").alias("rank"), at(F.floor("rank")).alias("low"), at(F.ceil("rank")).alias("high"))
    found = staged(picked.select(*keys, "which", "spot", between(F.col("rank"), F.col("low"), F.col("high")).alias("at")))
    out = found.groupBy(*keys, "which").agg(F.transform(F.array_sort(F.collect_list(F.struct("spot", "at"))), lambda x: x["at"]).alias("p"))
    missed = found.where("at is null").select(*keys, "which").distinct()
    if not missed.isEmpty():
        again = long.join(missed, [*keys, "which"], "left_semi").groupBy(*keys, "which", "value").agg(F.count("*").alias("n"))
        every = sorted({p for w in wanted for p in w.shares})
        place = F.element_at(F.create_map(*[F.lit(x) for i, w in enumerate(wanted) for x in (i, [every.index(p) for p in w.shares])]), F.col("which"))
        whole = counted_percentiles(again, [*keys, "which"], every)
        out = out.join(missed, [*keys, "which"], "left_anti").unionByName(whole.select(*keys, "which", F.transform(place, lambda k: F.get("p", k)).alias("p")))
    wide = out.groupBy(*keys).pivot("which", list(range(len(wanted)))).agg(F.first("p"))
    return known.select(*keys).distinct().join(wide, keys, "left").select(*keys, *[F.col(str(i)).alias(w.name) for i, w in enumerate(wanted)])


def exact_medians(rows: DataFrame, keys: list[str], columns: Sequence[str], prefix: str = "") -> DataFrame:
    """(keys, a median of each column) by ``exact_percentiles``."""
    found = exact_percentiles(rows, keys, [Wanted(c, F.col(c), (0.5,)) for c in columns])
    return found.select(*keys, *[F.col(c)[0].alias(f"{prefix}{c}") for c in columns])


def counted_percentiles(counted: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """(keys, p): interpolated percentiles of each group of (keys, value, n), ``n`` copies of each value.

    Values are range-partitioned by group and value, so a group of any size is a run of
    partitions. Their sizes, one row a group and partition, give the rank at which each
    starts; running sums inside a partition give the rank of every value, and only the
    values at the wanted ranks are kept. No task holds a whole group. Values with ``n``
    not above 0 are left out; a group without values has no row.
    """
    ranged = staged(counted.where("n > 0").repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id()))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "part")
        .agg(F.sum("n").alias("size"))
        .withColumns({"before": F.coalesce(F.sum("size").over(earlier), F.lit(0)), "total": F.sum("size").over(group)})
        .drop("size")
    )
    inside = Window.partitionBy(*keys, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranks = ranged.withColumn("upto", F.sum("n").over(inside)).join(starts, [*keys, "part"])
    last = F.col("before") + F.col("upto") - 1
    spot = [F.lit(p) * (F.col("total") - 1) for p in shares]
    holds = lambda rank: F.when((rank <= last) & (rank > last - F.col("n")), F.col("value"))
    found = ranks.groupBy(*keys).agg(
        F.first("total").alias("total"), *[F.max(holds(f(s))).alias(f"{name}{i}") for i, s in enumerate(spot) for name, f in (("low", F.floor), ("high", F.ceil))]
    )
    between = [F.when(F.floor(s) == F.ceil(s), F.col(f"low{i}")).otherwise((F.ceil(s) - s) * F.col(f"low{i}") + (s - F.floor(s)) * F.col(f"high{i}")) for i, s in enumerate(spot)]
    return found.select(*keys, F.array(*between).alias("p"))
