"""Exact percentiles by bracketing, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.functions import quantiles
from fleetlens.functions.quantiles import Wanted, exact_medians, exact_percentiles

SHARES = (0.25, 0.5, 0.75, 0.9)


def groups():
    rng = np.random.default_rng(5)
    return {
        "hot": rng.normal(0, 100, 30_000),
        "ties": rng.choice([0.0, 1.0, 2.5, 9.0], 5_000),
        "one": np.array([3.0]),
        "two": np.array([1.0, 2.0]),
        "equal": np.full(700, 7.0),
        "odd": np.concatenate([rng.exponential(1, 999), [np.nan] * 50]),
        "none": np.array([np.nan, np.nan]),
        None: rng.normal(5, 1, 200),
    }


def table(spark):
    rows = [(k, None if np.isnan(v) else float(v), None if np.isnan(v) else float(-2 * v)) for k, vs in groups().items() for v in vs]
    return spark.createDataFrame(rows, "g string, value double, other double").where("g is not null").repartition(7)


def check(rows):
    got = {r.g: r for r in rows}
    for key, values in groups().items():
        if key is None:
            continue
        known = values[~np.isnan(values)]
        if not len(known):
            assert got[key].a is None and got[key].b is None
            continue
        assert np.allclose(got[key].a, np.quantile(known, SHARES), rtol=1e-12, atol=1e-12)
        assert np.allclose(got[key].b, np.quantile(-2 * known, [0.95]), rtol=1e-12, atol=1e-12)
    assert len(got) == len(groups()) - 1


def wanted():
    return [Wanted("a", F.col("value"), SHARES), Wanted("b", F.col("other"), (0.95,))]


def test_equals_numpy(spark):
    check(exact_percentiles(table(spark), ["g"], wanted()).collect())


def test_ranks_beside_their_brackets_are_found(spark, monkeypatch):
    """Brackets of a coarse sketch without reach miss ranks; these are looked up again."""
    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    monkeypatch.setattr(quantiles, "REACH", 0.0)
    check(exact_percentiles(table(spark), ["g"], wanted()).collect())


def test_few_values_are_shuffled(spark):
    """What the second scan counts is a small part of the values of a large group."""
    rows = spark.range(200_000).select(F.lit("g").alias("g"), F.rand(3).alias("value"))
    found = exact_percentiles(rows, ["g"], [Wanted("p", F.col("value"), (0.5,))])
    assert found.count() == 1
    low, high = rows.agg(F.percentile_approx("value", F.array(F.lit(0.5 - quantiles.REACH), F.lit(0.5 + quantiles.REACH)), quantiles.ACCURACY)).first()[0]
    assert rows.where(F.col("value").between(low, high)).count() < 200_000 * 8 / quantiles.ACCURACY


def test_several_keys_and_no_rows(spark):
    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 4.0), ("a", 2, 5.0), ("b", 1, None)], "g string, h int, value double")
    got = {(r.g, r.h): r["mid_value"] for r in exact_medians(rows, ["g", "h"], ["value"], "mid_").collect()}
    assert got == {("a", 1): 2.5, ("a", 2): 5.0, ("b", 1): None}
    assert exact_medians(rows.limit(0), ["g", "h"], ["value"]).collect() == []


@pytest.mark.parametrize("rank, want", [(1.0, 10.0), (1.25, 12.5)])
def test_interpolation(spark, rank, want):
    assert spark.range(1).select(quantiles.between(F.lit(rank), F.lit(10.0), F.lit(20.0)).alias("x")).first().x == want
