"""Small column functions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VEHICLE = ("variant", "imei")


def micros(c: str | Column) -> Column:
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def number(c: Column) -> Column:
    """Text to a finite double; anything else is NULL."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def small_integer(c: Column) -> Column:
    """Text to a small integer; fractions and bad values are NULL."""
    x = number(c)
    return F.when((x == F.floor(x)) & (F.abs(x) <= 32767), x).cast("short")


def vehicle_id(c: Column) -> Column:
    """Normalised id: trimmed; empty and missing words are NULL; whole numbers lose exponent and fraction."""
    t = F.trim(c.cast("string"))
    x = number(t)
    whole = F.when(x == F.floor(x), x.try_cast("decimal(38,0)")).cast("string")
    return F.when(t.isNull() | F.lower(t).isin("", "nan", "none", "<na>"), None).when(t.rlike(r"^[1-9]\d*$"), t).otherwise(F.coalesce(whole, t))


def half_even_bin(c: Column, width: float) -> Column:
    """Nearest multiple of ``width``; halves to the even multiple; NULL stays."""
    return (F.bround(c / F.lit(width)) * F.lit(width)).cast("long")


def ratio(a: Column, b: Column) -> Column:
    """a / b where b > 0, else NULL."""
    return F.when(b > 0, a / b)


def mode_class(m0: str = "mode_0_frac", m1: str = "mode_1_frac") -> Column:
    return F.when(F.col(m1) >= F.col(m0), "thunder").otherwise("eco")


def deviation(value: Column, fleet: Column) -> Column:
    """Per cent off the fleet value; NULL where the fleet value is 0 or missing."""
    return F.when(fleet != 0, (value - fleet) / fleet * 100)


def deviation_band(dev: Column, has_bucket: Column) -> Column:
    return F.when(~has_bucket, "no-bucket").when(dev.isNull(), "n/a").when(F.abs(dev) < 15, "ok").when(F.abs(dev) < 30, "warn").otherwise("alert")


def detector_status(events: Column, fleet: Column) -> Column:
    return F.when(events <= 0, "ok").when(fleet.isNull() | (fleet <= 0), "alert").when(events > 2 * fleet, "alert").otherwise("warn")


def severity(tier: Column) -> Column:
    return F.when(tier >= 2, "HIGH").when(tier == 1, "MEDIUM").otherwise("NORMAL")


def verdict_severity(verdict: Column) -> Column:
    return F.when(verdict == "ELEVATED", "HIGH").when(verdict == "WATCH", "MEDIUM").otherwise("NORMAL")


def verdict_rank(verdict: Column) -> Column:
    return F.when(verdict == "ELEVATED", 0).when(verdict == "WATCH", 1).when(verdict == "NORMAL", 2).otherwise(9)


def edge_bin(c: Column, low: float, high: float, bins: int) -> Column:
    """Left-closed equal bins; the last is closed on both sides; outside is NULL."""
    index = F.floor((c - F.lit(low)) / F.lit((high - low) / bins))
    return F.when((c >= low) & (c < high), F.least(index, F.lit(bins - 1))).when(c == high, F.lit(bins - 1)).cast("int")


def uneven_bin(c: Column, edges: list[float]) -> Column:
    """The same rule over uneven edges, as a ladder of conditions."""
    out = F.when(c.isNull() | (c < edges[0]), None)
    for i, top in enumerate(edges[1:]):
        out = out.when(c <= top if i + 2 == len(edges) else c < top, F.lit(i))
    return out.cast("int")
