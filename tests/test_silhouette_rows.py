"""What the silhouette moves grows with the vehicles, and its distances are exact."""

import numpy as np
import pandas as pd
import pytest

from fleetlens.operators import ml


def table(spark, x, labels, variant="v"):
    frame = pd.DataFrame(x, columns=list(ml.FEATURES)).assign(variant=variant, imei=[str(i) for i in range(len(x))])
    frame["labels"] = [{k: int(v[i]) for k, v in labels.items()} for i in range(len(x))]
    return spark.createDataFrame(frame, ", ".join(f"{f} double" for f in ml.FEATURES) + ", variant string, imei string, labels map<int,int>")


def shuffled(spark, work):
    """Rows written to shuffles by the stages that ``work`` runs."""
    context = spark.sparkContext._jsc.sc()

    def written():
        context.listenerBus().waitUntilEmpty(30_000)
        every = spark._jvm.java.util.ArrayList()
        stages = context.statusStore().stageList(every, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), every)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    before = written()
    work()
    return sum(n for i, n in written().items() if i not in before)


def drawn(n):
    return np.round(np.random.default_rng(5).normal(size=(n, len(ml.FEATURES))), 6)


def test_moved_rows_grow_with_the_vehicles(spark, monkeypatch):
    monkeypatch.setattr(ml, "TILE", 10)
    moved = []
    for n in (200, 800):
        assigned = table(spark, drawn(n), {2: np.arange(n) % 2, 3: np.arange(n) % 3}).localCheckpoint()
        moved.append(shuffled(spark, ml.silhouettes(assigned).collect))
    assert moved[1] < 5 * moved[0]


@pytest.mark.parametrize("bound", ["HELD", None])
def test_larger_variants_have_more_tiles(spark, monkeypatch, bound):
    """Tiles over HELD vehicles are cut again; several variants, one of them with fewer clusters, keep their own sums."""
    if bound:
        monkeypatch.setattr(ml, bound, 15)
    x, labels = drawn(330), {2: np.arange(330) % 2, 3: np.arange(330) % 3}
    both = table(spark, x, labels).unionByName(table(spark, x[:40] * 2, {2: labels[2][:40]}, "w"))
    got = {(r.variant, r.k): r.silhouette for r in ml.silhouettes(both).collect()}
    assert set(got) == {("v", 2), ("v", 3), ("w", 2)}
    assert all(np.isclose(got["v", k], ml.silhouette(x, own), rtol=1e-9) for k, own in labels.items())
    assert np.isclose(got["w", 2], ml.silhouette(x[:40] * 2, labels[2][:40]), rtol=1e-9)


def test_distances_of_equal_near_and_far_rows():
    """Equal rows are 0 apart, rows one step apart keep that step, and rows too long for exact products are measured."""
    x = drawn(300)
    x[1], x[2], x[3], x[4] = x[0], x[0], x[0] * 1e5, x[0] * 1e5
    x[2, 0] += 1e-6
    x[5] = x[3]
    x[5, 0] += 1
    one = np.eye(len(x))
    there, back = ml.distance_sums(x, x, one, one)
    want = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    assert np.allclose(there, want, rtol=1e-9, atol=1e-12) and np.allclose(back, want.T, rtol=1e-9, atol=1e-12)
    assert there[0, 1] == 0.0 and there[3, 4] == 0.0


def test_one_cluster_and_lone_members(spark):
    x = drawn(30)
    got = {r.k: r.silhouette for r in ml.silhouettes(table(spark, x, {2: np.zeros(30), 3: np.r_[2, 1, np.zeros(28)]})).collect()}
    assert got[2] is None and np.isclose(got[3], ml.silhouette(x, np.r_[2, 1, np.zeros(28)]), rtol=1e-9)


def test_no_vehicles(spark):
    assert ml.silhouettes(table(spark, drawn(1), {2: np.zeros(1)}).limit(0)).collect() == []
