"""Exact neighbours by cells against all distances in numpy."""

import numpy as np

from fleetlens.operators import nearest


def plain(points, keep):
    out = set()
    for g in {g for g, _, _ in points}:
        ids = [i for h, i, _ in points if h == g]
        x = np.array([v for h, _, v in points if h == g], dtype=float)
        d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9)
        for a, i in enumerate(ids):
            order = sorted((d[a, b], j) for b, j in enumerate(ids) if j != i)[:keep]
            out |= {(g, i, j, float(far), k + 1) for k, (far, j) in enumerate(order)}
    return out


def run(spark, points, keep, **more):
    df = spark.createDataFrame(points, "grp string, id string, v array<double>").repartition(3)
    return {(r.grp, r.id, r.peer, r.distance, r.rank) for r in nearest.nearest(df, keep, **more).collect()}


def clustered(rng, n, width=4, kinds=12):
    return rng.normal(0, 50, (kinds, width))[rng.integers(kinds, size=n)] + rng.normal(0, 1, (n, width))


def test_equals_all_distances(spark):
    rng = np.random.default_rng(2)
    points = [("a", f"i{k}", v.tolist()) for k, v in enumerate(clustered(rng, 300))]
    points += [("b", f"i{k}", v.tolist()) for k, v in enumerate(rng.normal(0, 1, (60, 4)))]
    points += [("c", f"i{k}", rng.integers(0, 2, 4).astype(float).tolist()) for k in range(120)]  # many equal points and ties
    points += [("d", "one", [0.0] * 4), ("e", "x", [0.0] * 4), ("e", "y", [-0.0] * 4)]
    assert run(spark, points, 5) == run(spark, points, 5, tile=16) == plain(points, 5)


def test_equal_points_stay_linear(spark):
    points = [("g", f"{k:05d}", [1.0, 2.0]) for k in range(3000)] + [("g", f"x{k}", [float(k), 0.0]) for k in range(40)]
    got = run(spark, points, 4)
    assert len(got) == 4 * len(points) and got == plain(points[:8] + points[3000:], 4) | {r for r in got if r[1] >= "00008" and r[1] < "x"}
    assert {r[2] for r in got if "00008" <= r[1] < "x"} == {"00000", "00001", "00002", "00003"}
    df = spark.createDataFrame(points, "grp string, id string, v array<double>")
    _, candidates = nearest.dealt(df, 5)
    assert candidates.count() == 5 + 40 + 0 or candidates.where("v = array(1d, 2d)").count() == 5


def test_share_of_pairs_falls(spark):
    rng = np.random.default_rng(4)
    shares = []
    for n in (400, 8000):
        df = spark.createDataFrame([("g", f"{k}", v.tolist()) for k, v in enumerate(clustered(rng, n, 4, 20))], "grp string, id string, v array<double>")
        _, candidates = nearest.dealt(df, 21)
        placed, cells = nearest.celled(candidates)
        shares.append(nearest.compared_share(placed, nearest.asked_cells(placed, cells, 21)).first().share)
    assert shares[1] < 0.5 * shares[0] and shares[1] < 0.2


def test_blocks_of_few_candidates_and_far_points(spark):
    """Many blocks a group, a point far off all others, and no row for each target and cell."""
    rng = np.random.default_rng(6)
    points = [("a", f"i{k}", v.tolist()) for k, v in enumerate(rng.normal(0, 1, (700, 9)).round(2))] + [("a", "far", [1e9] * 9)]
    points += [("b", f"i{k}", [float(k % 3), 0.5]) for k in range(150)]
    ranks = lambda found: {(g, i, peer, rank) for g, i, peer, _, rank in found}
    assert ranks(run(spark, points, 6, tile=2)) == ranks(plain(points, 6))
    df = spark.createDataFrame(points, "grp string, id string, v array<double>")
    placed, cells = nearest.celled(nearest.dealt(df, 7)[1])
    held = cells.blocks(100)["a"]
    assert len(held) >= 4 and sorted(c for some, _ in held for c in some) == np.flatnonzero(cells.count["a"]).tolist()
    assert nearest.bounded(placed, cells, 7).where("grp = 'a'").count() == 701
