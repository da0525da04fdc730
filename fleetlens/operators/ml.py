"""Vehicle features and the unsupervised outlier stage.

Features, imputation, scaling and all percentiles are Spark aggregates over every vehicle.
Clusters: starting centres by oversampling in rounds (k-means||: Bahmani and others 2012),
moved by means over all vehicles of a variant; the number of clusters by the exact
silhouette, summed over pairs of few large tiles, so that what travels grows with the
vehicles and only the work inside tasks with their pairs. Forest (Liu, Ting and Zhou 2008): each tree is
grown from its own draw out of the whole variant and is kept as rows; every vehicle is
scored in groups of bounded size. All chance comes from digests of ids, so that results
do not depend on partitions and SQL can repeat them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.config import DEFAULT, SIGNALS, Settings
from fleetlens.functions.core import VEHICLE, severity
from fleetlens.functions.quantiles import Wanted, exact_medians, exact_percentiles
from fleetlens.functions.shared import small, staged
from fleetlens.operators.sessions import driving

FEATURES = tuple(f"{s}_{k}" for s in SIGNALS for k in ("p50", "p90", "iqr"))
#: Vehicles of one scoring group.
SCORE_VEHICLES = 50_000
#: Tiles of the silhouette: vehicles of one in small variants, tiles of a variant at most unless they would hold more than HELD vehicles.
TILE, SPREAD, HELD = 1000, 12, 100_000
#: Rows and columns of a product of matrices in the silhouette.
AT_ONCE, ACROSS = 128, 1024
#: Steps of the grid of the features in one unit, and the squared length in steps up to which such products are exact: sums stay within 2**53.
GRID, EXACT = 1e6, 2.0**51
#: Seeding: rounds, and vehicles drawn on average in each; turns of the centres at most.
ROUNDS, OVERSAMPLED, TURNS = 2, 6, 25
#: Vehicles of a tree, and how many are drawn on average so that enough are there.
SUBSAMPLE, DRAWN = 256, 400


def vehicle_features(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Median, 90th percentile and IQR of seven signals over driving rows of vehicles with enough of them."""
    ps = F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.9)))
    out = driving(rows).groupBy(*VEHICLE).agg(F.count("*").alias("n_records"), *[F.percentile(s, ps).alias(s) for s in SIGNALS])
    cols = []
    for s in SIGNALS:
        cols += [F.col(s)[1].alias(f"{s}_p50"), F.col(s)[3].alias(f"{s}_p90"), (F.col(s)[2] - F.col(s)[0]).alias(f"{s}_iqr")]
    return out.where(F.col("n_records") >= settings.min_feature_rows).select(*VEHICLE, "n_records", *cols)


def standardised(features: DataFrame) -> DataFrame:
    """Missing features at the variant's median, then (x - mean) / population deviation; deviation 0 counts as 1."""
    features = staged(features)
    med = staged(exact_medians(features, ["variant"], FEATURES, "med_"))
    filled = features.join(small(med), "variant").select(*VEHICLE, "n_records", *[F.coalesce(f, f"med_{f}", F.lit(0.0)).alias(f) for f in FEATURES])
    stats = staged(filled.groupBy("variant").agg(F.count("*").alias("cohort"), *[F.avg(f).alias(f"mean_{f}") for f in FEATURES], *[F.stddev_pop(f).alias(f"sd_{f}") for f in FEATURES]))
    z = [((F.col(f) - F.col(f"mean_{f}")) / F.when(F.col(f"sd_{f}") > 1e-12, F.col(f"sd_{f}")).otherwise(1.0)).alias(f) for f in FEATURES]
    return filled.join(small(stats), "variant").select(*VEHICLE, "n_records", "cohort", *z)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = np.sqrt(((x[:, None] - centres) ** 2).sum(2))
    own = d.argmin(1)
    return own, d[np.arange(len(x)), own]


def silhouette(x: np.ndarray, own: np.ndarray) -> float:
    """Mean Euclidean silhouette, in blocks of rows; lone members score 0."""
    kinds, sizes = np.unique(own, return_counts=True)
    if len(kinds) < 2:
        return -np.inf
    total = 0.0
    for i in range(0, len(x), 256):
        d = np.sqrt(np.maximum(((x[i : i + 256, None] - x) ** 2).sum(2), 0))
        sums = np.stack([d[:, own == k].sum(1) for k in kinds], 1)
        me = np.searchsorted(kinds, own[i : i + 256])
        at = np.arange(len(me))
        a = sums[at, me] / np.maximum(sizes[me] - 1, 1)
        means = sums / sizes
        means[at, me] = np.inf
        b = means.min(1)
        total += np.where(sizes[me] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-12), 0.0).sum()
    return total / len(x)


def path_length(n) -> np.ndarray:
    """Mean path of a failed search in a binary tree of n leaves."""
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def draw_of(*parts) -> float:
    """A number between 0 and 1 from the digest of parts; ``draw`` gives the same in Spark."""
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) + 0.5) / 2.0**32


def draw(*parts) -> Column:
    digest = F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0**32)


def grow_tree(x: np.ndarray, seed: int, tree: int) -> list[tuple]:
    """One tree as rows (node, feature, cut, path): children of a node are 2 node and 2 node + 1.

    Inner nodes have a feature; leaves have feature -1 and the expected path to a vehicle.
    """
    top = int(np.ceil(np.log2(max(len(x), 2))))
    rows, work = [], [(1, x, 0)]
    while work:
        node, part, depth = work.pop()
        low, high = part.min(0), part.max(0)
        free = np.flatnonzero(high > low)
        if depth >= top or len(part) <= 1 or not len(free):
            rows.append((node, -1, 0.0, depth + float(path_length(len(part)))))
            continue
        f = int(free[int(draw_of(seed, tree, node, "feature") * len(free))])
        cut = float(low[f] + draw_of(seed, tree, node, "cut") * (high[f] - low[f]))
        rows.append((node, f, cut, 0.0))
        left = part[:, f] < cut
        work += [(2 * node, part[left], depth + 1), (2 * node + 1, part[~left], depth + 1)]
    return rows


def forest_score(forest: list[list[tuple]], x: np.ndarray, size: int) -> np.ndarray:
    """2 ** (-mean path / expected path); higher is odder. ``size``: vehicles of the variant."""
    total = np.zeros(len(x))
    for rows in forest:
        table = {int(r[0]): i for i, r in enumerate(rows)}
        node, f, cut, path = (np.array(c) for c in zip(*rows))
        left = np.array([table.get(2 * int(n), 0) for n in node])
        right = np.array([table.get(2 * int(n) + 1, 0) for n in node])
        at = np.full(len(x), table[1])
        while (inner := f[at] >= 0).any():
            low = x[np.arange(len(x)), np.maximum(f[at], 0)] < cut[at]
            at = np.where(inner, np.where(low, left[at], right[at]), at)
        total += path[at]
    return 2.0 ** (-total / len(forest) / max(float(path_length(min(SUBSAMPLE, size))), 1e-9))


def _matrix(part: pd.DataFrame) -> np.ndarray:
    return part[list(FEATURES)].to_numpy(dtype=float)


def gridded(z: DataFrame) -> DataFrame:
    """Features to six places, so that sums in another order change no choice."""
    return z.select(*[(F.floor(F.col(c) * GRID + 0.5) / GRID).alias(c) if c in FEATURES else F.col(c) for c in z.columns])


def _per_batch(big: DataFrame, work, schema: str) -> DataFrame:
    """``work(variant, matrix, part)`` yields rows of each variant of each batch."""

    def run(batches):
        for batch in batches:
            for v, part in batch.groupby("variant"):
                rows = list(work(v, _matrix(part), part))
                if rows:
                    yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return big.mapInPandas(run, schema)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None] - centres) ** 2).sum(2)


def start_centres(big: DataFrame, settings: Settings = DEFAULT) -> dict[str, list[np.ndarray]]:
    """Starting centres of every variant and restart, ``k_max`` of each, in order of choice.

    The first candidate has the least draw; each round adds every vehicle with a chance in
    proportion to its squared distance to the candidates, OVERSAMPLED in the mean. Candidates
    count the vehicles they are nearest to; the first centre is the one with most, the
    next ones have most vehicles times squared distance. A few rows a variant reach the driver.
    """
    restarts = range(settings.restarts)
    point = F.array(*FEATURES)
    draws = F.array(*[F.array(*[draw(settings.seed, F.col("imei"), s, r) for r in range(ROUNDS + 1)]) for s in restarts])
    drawn = staged(big.select("variant", "imei", *FEATURES, draws.alias("draws")))
    firsts = drawn.groupBy("variant").agg(*[F.min_by(F.struct("imei", point.alias("x")), F.struct(F.col("draws")[s][0], "imei")).alias(f"s{s}") for s in restarts])
    held = {r.variant: [{r[f"s{s}"].imei: r[f"s{s}"].x} for s in restarts] for r in firsts.collect()}
    tables = lambda: {v: [np.array(list(c.values())) for c in sets] for v, sets in held.items()}
    for turn in range(1, ROUNDS + 1):
        now = tables()

        def cost(v, x, part):
            return [(v, s, float(_gaps(x, now[v][s]).min(1).sum())) for s in restarts]

        sums = _per_batch(drawn, cost, "variant string, s int, cost double").groupBy("variant", "s").agg(F.sum("cost").alias("cost"))
        whole = {(r.variant, r.s): r.cost for r in sums.collect()}

        def chosen(v, x, part):
            chance = np.array([[d[s][turn] for s in restarts] for d in part["draws"]])
            ids = part["imei"].to_numpy()
            for s in restarts:
                for i in np.flatnonzero(chance[:, s] * whole[v, s] < OVERSAMPLED * _gaps(x, now[v][s]).min(1)):
                    yield v, s, ids[i], x[i].tolist()

        for r in _per_batch(drawn, chosen, "variant string, s int, imei string, x array<double>").collect():
            held[r.variant][r.s][r.imei] = r.x
    held = {v: [dict(sorted(c.items())) for c in sets] for v, sets in held.items()}
    now = tables()

    def weights(v, x, part):
        for s in restarts:
            own, n = np.unique(_gaps(x, now[v][s]).argmin(1), return_counts=True)
            yield from [(v, s, int(c), int(m)) for c, m in zip(own, n)]

    heavy = {v: [np.zeros(len(c)) for c in sets] for v, sets in now.items()}
    for r in _per_batch(drawn, weights, "variant string, s int, c int, n long").groupBy("variant", "s", "c").agg(F.sum("n").alias("n")).collect():
        heavy[r.variant][r.s][r.c] = r.n
    out: dict[str, list[np.ndarray]] = {}
    for v, sets in now.items():
        out[v] = []
        for c, w in zip(sets, heavy[v]):
            picked = [int(w.argmax())]
            while len(picked) < settings.k_max:
                picked.append(int((w * _gaps(c, c[picked]).min(1)).argmax()))
            out[v].append(c[picked])
    return out


def moved_centres(big: DataFrame, runs: dict[str, dict[tuple[int, int], np.ndarray]], turns: int = TURNS) -> dict[str, dict[tuple[int, int], np.ndarray]]:
    """Turns over all vehicles until no centre of any run moves; one row a variant, run and cluster reaches the driver."""
    width = len(FEATURES)
    still = {v: dict(r) for v, r in runs.items()}
    now = runs
    for _ in range(turns):
        if not now:
            break

        def sums(batches):
            held: dict[tuple, list] = {}
            for batch in batches:
                for v, part in batch.groupby("variant"):
                    x = _matrix(part)
                    for (k, s), c in now.get(v, {}).items():
                        own = _gaps(x, c).argmin(1)
                        for i in np.unique(own):
                            old = held.setdefault((v, k, s, int(i)), [0, np.zeros(width)])
                            old[0] += int((own == i).sum())
                            old[1] += x[own == i].sum(0)
            if held:
                yield pd.DataFrame([(*key, n, list(t)) for key, (n, t) in held.items()], columns=["variant", "k", "s", "c", "n", "sums"])

        parts = big.select("variant", *FEATURES).mapInPandas(sums, "variant string, k int, s int, c int, n long, sums array<double>")
        found = parts.groupBy("variant", "k", "s", "c").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect()
        new = {v: {run: c.copy() for run, c in r.items()} for v, r in now.items()}
        for r in found:
            new[r.variant][r.k, r.s][r.c] = np.array(r.sums) / r.n
        # Runs whose centres stand still are done.
        moving = {v: {run: c for run, c in r.items() if not np.allclose(c, now[v][run], rtol=0, atol=1e-12)} for v, r in new.items()}
        for v, r in new.items():
            still[v].update(r)
        now = {v: r for v, r in moving.items() if r}
    return still


def distance_sums(x: np.ndarray, y: np.ndarray, of_x: np.ndarray, of_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of every row of ``x`` to the rows of ``y``, summed by the 0/1 columns ``of_y``, and of every row of ``y`` to ``x`` by ``of_x``.

    Features are whole numbers of grid steps, so |a|^2 + |b|^2 - 2ab as a product of matrices is exact
    while lengths are within EXACT; longer rows, of which a standardised table has few, are measured one by one.
    """
    x, y = np.rint(x * GRID), np.rint(y * GRID)
    from_x, from_y = np.zeros((len(x), of_y.shape[1])), np.zeros((len(y), of_x.shape[1]))
    long_x, long_y = ((z**2).sum(1) for z in (x, y))
    right = np.hstack([y, long_y[:, None], np.ones((len(y), 1))])
    for i in range(0, len(x), AT_ONCE):
        some = slice(i, i + AT_ONCE)
        left = np.hstack([-2 * x[some], np.ones((len(x[some]), 1)), long_x[some, None]])
        rows, kinds = np.flatnonzero(long_x[some] > EXACT), np.ascontiguousarray(of_x[some].T)
        for j in range(0, len(y), ACROSS):
            held = slice(j, j + ACROSS)
            d = left @ right[held].T
            if len(rows):
                d[rows] = _gaps(x[some][rows], y[held])
            columns = np.flatnonzero(long_y[held] > EXACT)
            if len(columns):
                d[:, columns] = _gaps(x[some], y[held][columns])
            np.sqrt(d, out=d)
            from_x[some] += d @ of_y[held]
            from_y[held] += (kinds @ d).T
    return from_x / GRID, from_y / GRID


def silhouettes(assigned: DataFrame) -> DataFrame:
    """(variant, k, silhouette): mean Euclidean silhouette of (variant, imei, features on the grid, labels below k by k), exactly.

    Each pair of tiles is one task's group and gives its distances, summed by cluster, to the
    vehicles of both. A vehicle travels once for each tile of its variant, and there are
    SPREAD of these at most up to SPREAD * HELD vehicles. A lone member of a cluster scores 0,
    and a split with one cluster only has none.
    """
    spread = int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ks = sorted(r.k for r in assigned.select(F.explode(F.map_keys("labels")).alias("k")).distinct().collect())
    if not ks:
        return assigned.select("variant", F.lit(0).alias("k"), F.lit(0.0).alias("silhouette")).limit(0)
    cells = [(k, c) for k in ks for c in range(k)]
    n = F.count("*")
    tiles = F.greatest(F.least(F.ceil(n / TILE), F.lit(SPREAD)), F.ceil(n / HELD)).cast("int").alias("tiles")
    sizes = small(staged(assigned.groupBy("variant").agg(tiles, *[F.count_if(F.col("labels")[k] == c).alias(f"n_{k}_{c}") for k, c in cells])))
    tiled = assigned.join(sizes, "variant").withColumn("tile", F.pmod(F.xxhash64("imei"), F.col("tiles")).cast("int"))
    own = [F.col("labels")[k].alias(f"own_{k}") for k in ks]
    other = tiled.select("variant", "imei", *own, *FEATURES, "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    # A number of partitions of our own, as in ``grown_forests``: pairs of tiles are few and each is work.
    pairs = other.select("*", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")).drop("other").repartition(spread, "variant", "low", "high")
    kept, far = ["variant", "imei", *[f"own_{k}" for k in ks]], [f"far_{k}_{c}" for k, c in cells]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        low, high = part["low"].iloc[0], part["high"].iloc[0]
        one, two = part[part["tile"] == low], part[part["tile"] == high]
        of = [np.stack([(p[f"own_{k}"] == c).to_numpy(dtype=float) for k, c in cells], 1) for p in (one, two)]
        sums = distance_sums(_matrix(one), _matrix(two), *of)
        # A pair without one of its tiles gives sums of 0. Of a tile with itself, both sides are the same sums.
        return pd.concat([p[kept].reset_index(drop=True).join(pd.DataFrame(t, columns=far)) for p, t in zip((one, two), sums[: 1 if low == high else 2])])

    schema = ", ".join(["variant string, imei string", *[f"own_{k} int" for k in ks], *[f"{f} double" for f in far]])
    sums = pairs.groupBy("variant", "low", "high").applyInPandas(run, schema).groupBy(*VEHICLE).agg(*[F.max(f"own_{k}").alias(f"own_{k}") for k in ks], *[F.sum(f).alias(f) for f in far])
    scores = []
    for k in ks:
        mine = F.col(f"own_{k}")
        size, inside = (F.get(F.array(*[f"{name}_{k}_{c}" for c in range(k)]), mine) for name in ("n", "far"))
        a = inside / F.greatest(size - 1, F.lit(1))
        b = F.array_min(F.array(*[F.when((mine != c) & (F.col(f"n_{k}_{c}") > 0), F.col(f"far_{k}_{c}") / F.col(f"n_{k}_{c}")) for c in range(k)]))
        score = F.when(size > 1, (b - a) / F.greatest(a, b, F.lit(1e-12))).when(b.isNotNull(), 0.0)
        scores.append(F.struct(F.lit(k).alias("k"), F.count(mine).alias("held"), F.avg(score).alias("silhouette")))
    found = sums.join(sizes, "variant").groupBy("variant").agg(F.array(*scores).alias("found"))
    return found.select("variant", F.explode("found").alias("found")).select("variant", "found.*").where("held > 0").drop("held")


def chosen_centres(big: DataFrame, settings: Settings = DEFAULT) -> dict[str, np.ndarray]:
    """The centres of every variant: the best restart of each number of clusters, then the number with the best silhouette."""
    sizes = {r.variant: r.n for r in big.groupBy("variant").agg(F.count("*").alias("n")).collect()}
    starts = start_centres(big, settings)
    most = {v: max(2, min(settings.k_max, n // 5)) for v, n in sizes.items()}
    runs = moved_centres(big, {v: {(k, s): c[:k] for s, c in enumerate(sets) for k in range(2, most[v] + 1)} for v, sets in starts.items()})

    def cost(v, x, part):
        return [(v, k, s, float(_gaps(x, c).min(1).sum())) for (k, s), c in runs[v].items()]

    costs = _per_batch(big.select("variant", *FEATURES), cost, "variant string, k int, s int, cost double").groupBy("variant", "k", "s").agg(F.sum("cost").alias("cost"))
    best: dict[tuple[str, int], tuple] = {}
    for r in costs.collect():
        best[r.variant, r.k] = min(best.get((r.variant, r.k), (np.inf, 0)), (round(r.cost, 6), r.s))
    kept: dict[str, dict[int, np.ndarray]] = {}
    for (v, k), (_, s) in best.items():
        kept.setdefault(v, {})[k] = runs[v][k, s]

    def label(v, x, part):
        own = {k: _gaps(x, c).argmin(1) for k, c in kept[v].items()}
        for i, (imei, row) in enumerate(zip(part["imei"], x)):
            yield v, imei, {k: int(o[i]) for k, o in own.items()}, *row.tolist()

    columns = ", ".join(f"{f} double" for f in FEATURES)
    # A map type has a comma of its own, so the schema is put together by hand.
    names = ["variant", "imei", "labels", *FEATURES]

    def labelled(batches):
        for batch in batches:
            for v, part in batch.groupby("variant"):
                yield pd.DataFrame(list(label(v, _matrix(part), part)), columns=names)

    assigned = big.mapInPandas(labelled, f"variant string, imei string, labels map<int,int>, {columns}")
    found: dict[str, tuple] = {}
    for r in silhouettes(staged(assigned)).collect():
        score = -np.inf if r.silhouette is None else round(r.silhouette, 9)
        found[r.variant] = max(found.get(r.variant, (-np.inf, -99)), (score, -r.k))
    return {v: kept[v][-k] if -k in kept[v] else kept[v][2] for v, (_, k) in found.items()}


def grown_forests(big: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(variant, tree, node, feature, cut, path): every tree from its own draw of SUBSAMPLE vehicles of the whole variant.

    A vehicle joins the draw of a tree by a digest of both, with a chance that gives about
    DRAWN vehicles a tree; the SUBSAMPLE least draws of these are used.
    """
    trees = F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1))).alias("tree")
    rows = big.select("variant", "imei", "cohort", trees).withColumn("chance", draw(settings.seed, F.col("imei"), "tree", F.col("tree"))).where(F.col("chance") * F.col("cohort") < DRAWN)
    least = F.row_number().over(Window.partitionBy("variant", "tree").orderBy("chance", "imei"))
    drawn = rows.withColumn("place", least).where(F.col("place") <= SUBSAMPLE).drop("cohort", "place").join(big, list(VEHICLE))

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        variant, tree = part["variant"].iloc[0], int(part["tree"].iloc[0])
        return pd.DataFrame([(variant, tree, *row) for row in grow_tree(_matrix(part), settings.seed, tree)], columns=["variant", "tree", "node", "feature", "cut", "path"])

    # A number of partitions of our own: the rows are few, but growing a tree is work, so they are not to be merged.
    spread = drawn.select("variant", "tree", *FEATURES).repartition(int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")), "variant", "tree")
    return spread.groupBy("variant", "tree").applyInPandas(grow, "variant string, tree int, node long, feature int, cut double, path double")


def outlier_flags(features: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Flags of every vehicle with features; variants under the cohort minimum are all NORMAL."""
    z = staged(gridded(standardised(features)))
    big = z.where(F.col("cohort") >= settings.min_cohort)
    centres = chosen_centres(big, settings) if not big.isEmpty() else {}
    forest = grown_forests(big, settings).groupBy("variant").agg(F.collect_list(F.struct("tree", "node", "feature", "cut", "path")).alias("forest"))
    models = forest.join(big.groupBy("variant").agg(F.first("cohort").alias("cohort")), "variant")
    groups = lambda c: F.ceil(F.col(c) / SCORE_VEHICLES).cast("int")
    salted = big.withColumn("salt", F.pmod(F.xxhash64("imei"), groups("cohort")).cast("int"))
    copies = models.withColumn("salt", F.explode(F.sequence(F.lit(0), groups("cohort") - 1))).select("variant", "salt", "cohort", "forest")

    def score(part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({"variant": pd.Series([], dtype=object), "imei": pd.Series([], dtype=object), "cluster_id": pd.Series([], dtype="int32"), "distance": pd.Series([], dtype=float), "iso": pd.Series([], dtype=float)})
        trees: dict[int, list[tuple]] = {}
        for r in model["forest"].iloc[0]:
            trees.setdefault(r["tree"], []).append((r["node"], r["feature"], r["cut"], r["path"]))
        x = _matrix(part)
        own, far = nearest(x, centres[part["variant"].iloc[0]])
        iso = forest_score([trees[t] for t in sorted(trees)], x, int(model["cohort"].iloc[0]))
        return pd.DataFrame({"variant": part["variant"], "imei": part["imei"], "cluster_id": own.astype("int32"), "distance": np.round(far, 9), "iso": np.round(iso, 9)})

    scored = salted.groupBy("variant", "salt").cogroup(copies.groupBy("variant", "salt")).applyInPandas(score, "variant string, imei string, cluster_id int, distance double, iso double")
    marked = mark(scored, settings)
    zero = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return z.select(*VEHICLE, "n_records").join(marked, list(VEHICLE), "left").select(
        *VEHICLE, zero("is_anomaly", False), zero("isolation_score", 0.0), zero("distance_to_center", 0.0), zero("cluster_id", 0), zero("cluster_outlier", False),
        zero("isolation_outlier", False), zero("severity", "NORMAL"), zero("severity_tier", 0), "n_records",
    )


def mark(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Outliers of (variant, imei, cluster_id, distance, iso): the farthest and the oddest tenth."""
    top = 1 - settings.contamination
    scored = staged(scored)
    cut = staged(exact_percentiles(scored, ["variant"], [Wanted("far", F.col("distance"), (0.9,)), Wanted("odd", F.col("iso"), (top,))])).select("variant", F.col("far")[0].alias("far"), F.col("odd")[0].alias("odd"))
    # Rounded, so that a value on its own percentile falls the same way everywhere.
    by_far, by_odd = F.round("distance", 9) >= F.round("far", 9), F.round("iso", 9) > F.round("odd", 9)
    tier = by_far.cast("int") + by_odd.cast("int")
    return scored.join(small(cut), "variant").select(
        *VEHICLE, "cluster_id", F.bround("distance", 4).alias("distance_to_center"), F.bround("iso", 4).alias("isolation_score"), by_far.alias("cluster_outlier"),
        by_odd.alias("isolation_outlier"), (by_far | by_odd).alias("is_anomaly"), tier.alias("severity_tier"), severity(tier).alias("severity"),
    )
