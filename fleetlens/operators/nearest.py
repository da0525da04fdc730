"""Exact nearest neighbours inside groups, by cells around pivots.

Points are dealt to the cell of their nearest pivot. A point's neighbours in its own tile
of the cell bound how far its nearest ones can be, and the triangle inequality then rules
out every cell that is farther: only the cells left are searched (the Voronoi partitions
of Lu, Shen, Chen and Ooi 2012, "Efficient processing of k nearest neighbor joins using
MapReduce"). Points that are equal are one target, and their least ids are candidates, so
any number of equal points costs time in proportion.

Only points travel: pairs stay inside a task, and of each target and block no more than
the wanted number of rows comes back. A block is some HELD candidates of near cells, so a
target travels to a few blocks and not to each of its cells; inside a block a product of
matrices finds the pairs within a target's bound, and only these are measured exactly. The
driver holds the pivots and a count and radius for each cell, at most MOST_PIVOTS a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.shared import small, staged

#: Candidates of a tile, targets compared at once, and pivots of a group at most.
TILE, AT_ONCE, MOST_PIVOTS = 1000, 128, 1000
#: Candidates of a block, as tiles, and of a product of matrices; targets of a task, and tasks for the targets of a block unless they would have few.
HELD, ACROSS, TARGETS, SPREAD, FEW = 50, 4096, 16_000, 24, 2000
#: Points of a cell in the mean, in groups whose number of points is not above its square.
CELL = 200
#: Distances are ordered after rounding to nine places, so what may round to a bound stays.
SLACK = 2e-9
#: Share of a sum by which rounding may put it off, with room; it counts for points that are far from all others.
SAFE = 64 * np.finfo(float).eps


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2))


def chosen(targets: np.ndarray, candidates: np.ndarray, keep: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(offset, rows, columns, distances) of the ``keep`` nearest candidates, which are in order of id, of targets in turns."""
    keep = min(keep, len(candidates))
    for i in range(0, len(targets), AT_ONCE):
        d = _distances(targets[i : i + AT_ONCE], candidates)
        r = np.round(d, 9)
        last = np.partition(r, keep - 1, axis=1)[:, keep - 1 : keep]
        nearer, equal = r < last, r == last
        mask = nearer | (equal & (equal.cumsum(1) <= keep - nearer.sum(1)[:, None]))
        rows, columns = np.nonzero(mask)
        yield i, rows, columns, d[rows, columns]


def within(targets: np.ndarray, bound: np.ndarray, candidates: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, distances) of the ``keep`` nearest candidates, which are in order of id, within each target's bound.

    |a|^2 + |b|^2 - 2ab against the squared bound is one product of matrices, less a share of the squares
    that is above its rounding error; the pairs that it leaves in are measured. Where these are many, the
    bound comes down to the ``keep``-th of each turn of candidates.
    """
    square = lambda x: (x**2).sum(1) * (1 - SAFE)
    right = np.vstack([candidates.T, square(candidates)[None], np.ones(len(candidates))[None]])
    limit = bound.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for j in range(0, len(candidates), ACROSS):
        far = np.minimum((limit + SLACK) ** 2 * (1 + SAFE), 1e300)
        left = np.hstack([-2 * targets, np.ones((len(targets), 1)), (square(targets) - far)[:, None]])
        rows, columns = np.nonzero(left @ right[:, j : j + ACROSS] <= 0)
        parts = []
        for i in range(0, len(rows), ACROSS * AT_ONCE // 8):
            r, c = rows[i : i + ACROSS * AT_ONCE // 8], columns[i : i + ACROSS * AT_ONCE // 8] + j
            d = np.sqrt(((targets[r] - candidates[c]) ** 2).sum(1))
            near = d <= limit[r] + SLACK
            parts.append((r[near], c[near], d[near]))
        if parts:
            found.append(_first(*map(np.concatenate, zip(*parts)), keep))
            r, _, d = found[-1]
            many = np.bincount(r, minlength=len(targets)) >= keep
            worst = np.zeros(len(targets))
            np.maximum.at(worst, r, d)
            limit = np.where(many, np.minimum(limit, worst), limit)
    if not found:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
    return _first(*map(np.concatenate, zip(*found)), keep)


def _first(rows: np.ndarray, columns: np.ndarray, d: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` nearest of each row, equal ones in order of column."""
    order = np.lexsort((columns, np.round(d, 9), rows))
    rows, columns, d = rows[order], columns[order], d[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < keep], columns[place < keep], d[place < keep]


class Cells:
    """Pivots of every group, with the count and the radius of their cells."""

    def __init__(self, pivots: dict[str, np.ndarray]):
        self.pivots = pivots
        self.count = {g: np.zeros(len(p), dtype=np.int64) for g, p in pivots.items()}
        self.radius = {g: np.zeros(len(p)) for g, p in pivots.items()}

    def bounds(self, group: str, far: np.ndarray, keep: int) -> np.ndarray:
        """An upper bound of the distance of the ``keep``-th nearest candidate, from whole cells."""
        reach = np.where(self.count[group] > 0, (far + self.radius[group]) * (1 + SAFE), np.inf)
        order = np.argsort(reach, axis=1)
        enough = np.cumsum(self.count[group][order], axis=1) >= keep
        at = np.where(enough.any(1), enough.argmax(1), 0)
        found = np.take_along_axis(reach, np.take_along_axis(order, at[:, None], 1), 1)[:, 0]
        return np.where(enough.any(1), found, np.inf)

    def least(self, group: str, far: np.ndarray, own: np.ndarray) -> np.ndarray:
        """A lower bound of the distance to any candidate of each cell: by its radius, and by the plane between the pivots."""
        p = self.pivots[group]
        apart = np.sqrt(((p[own][:, None, :] - p[None, :, :]) ** 2).sum(2))
        mine = np.take_along_axis(far, own[:, None], 1)
        plane = np.where(apart > 0, (far**2 - mine**2 - SAFE * (far**2 + mine**2)) / np.where(apart > 0, 2 * apart, 1), 0.0)
        return np.where(self.count[group] > 0, np.maximum(far - self.radius[group] - SAFE * (far + self.radius[group]), plane), np.inf)

    def asked(self, group: str, x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(offset, mask): in turns of targets, the cells that may hold a candidate within each target's bound."""
        for i in range(0, len(x), AT_ONCE):
            some = slice(i, i + AT_ONCE)
            far = _distances(x[some], self.pivots[group])
            yield i, self.least(group, far, far.argmin(1)) <= bound[some, None] + SLACK

    def blocks(self, most: int) -> dict[str, list[tuple[np.ndarray, int]]]:
        """Near cells of each group together, with the number of tiles of ``most`` candidates: halves along the widest side of the pivots, until they hold no more or are one cell."""
        out: dict[str, list[tuple[np.ndarray, int]]] = {}
        for g, p in self.pivots.items():
            open_, out[g] = [np.flatnonzero(self.count[g] > 0)], []
            while open_:
                some = open_.pop()
                held = int(self.count[g][some].sum())
                if held <= most or len(some) == 1:
                    out[g].append((some, -(-held // most)))
                    continue
                side = np.ptp(p[some], axis=0).argmax()
                some = some[np.argsort(p[some, side], kind="stable")]
                upto = np.cumsum(self.count[g][some])
                cut = min(max(int(np.searchsorted(upto, held / 2)), 1), len(some) - 1)
                open_ += [some[:cut], some[cut:]]
        return out


def dealt(points: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """Points (grp, id, v): (grp, id, rep), the least id of equal points; and the candidates (grp, id, v, rep).

    Of equal points only the ``keep`` with the least ids can be a neighbour of anything.
    """
    place = Window.partitionBy("grp", "v").orderBy("id")
    reps = points.groupBy("grp", "v").agg(F.min("id").alias("rep"))
    members = points.join(reps, ["grp", "v"])
    few = points.withColumn("place", F.row_number().over(place)).where(F.col("place") <= keep).drop("place")
    return members.select("grp", "id", "rep"), few.join(reps, ["grp", "v"])


def celled(candidates: DataFrame) -> tuple[DataFrame, Cells]:
    """Candidates with cell, tile and distance to their pivot (staged), and the cells."""
    spots = candidates.where("id = rep")
    sizes = spots.groupBy("grp").agg(F.count("*").alias("n"))
    wanted = F.ceil(F.least(F.sqrt("n"), F.col("n") / CELL, F.lit(float(MOST_PIVOTS))))
    chance = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    drawn = spots.join(F.broadcast(sizes) if sizes.count() <= MOST_PIVOTS else sizes, "grp").withColumn("chance", chance).where(F.col("chance") * F.col("n") < 4 * wanted + 16)
    first = drawn.withColumn("k", F.row_number().over(Window.partitionBy("grp").orderBy("chance", "id"))).where(F.col("k") <= wanted)
    pivots: dict[str, list] = {}
    for r in first.select("grp", "v").collect():
        pivots.setdefault(r.grp, []).append(r.v)
    cells = Cells({g: np.array(p, dtype=float) for g, p in pivots.items()})

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g, part in batch.groupby("grp"):
                x, p = _matrix(part["v"]), cells.pivots[g]
                for i in range(0, len(x), AT_ONCE):
                    far = _distances(x[i : i + AT_ONCE], p)
                    own = far.argmin(1)
                    yield part.iloc[i : i + AT_ONCE].assign(cell=own.astype("int32"), far=far[np.arange(len(own)), own])

    placed = staged(candidates.mapInPandas(assign, "grp string, v array<double>, id string, rep string, cell int, far double"))
    stats = placed.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
    for r in stats.collect():
        cells.count[r.grp][r.cell], cells.radius[r.grp][r.cell] = r.n, r.radius
    return placed, cells


def bounded(placed: DataFrame, cells: Cells, keep: int, tile: int = TILE) -> DataFrame:
    """(grp, rep, v, bound): each distinct point, with a bound of the distance of its neighbours from its own tile and from whole cells."""
    tiles = placed.groupBy("grp", "cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiled = placed.join(tiles, ["grp", "cell"]).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        group, x = part["grp"].iloc[0], _matrix(part["v"])
        mine = (part["id"] == part["rep"]).to_numpy()
        targets = x[mine]
        bound = np.full(len(targets), np.inf)
        if len(x) >= keep:
            for i, rows, _, d in chosen(targets, x, keep):
                worst = np.zeros(rows.max() + 1 if len(rows) else 0)
                np.maximum.at(worst, rows, d)
                bound[i : i + len(worst)] = worst
        for i in range(0, len(targets), AT_ONCE):
            some = slice(i, i + AT_ONCE)
            bound[some] = np.minimum(bound[some], cells.bounds(group, _distances(targets[some], cells.pivots[group]), keep))
        return pd.DataFrame({"grp": group, "rep": part["rep"].to_numpy()[mine], "v": list(targets), "bound": bound})

    return tiled.groupBy("grp", "cell", "tile").applyInPandas(run, "grp string, rep string, v array<double>, bound double")


def asked_cells(placed: DataFrame, cells: Cells, keep: int, tile: int = TILE) -> DataFrame:
    """(grp, rep, cell): the cells that may hold a neighbour of each distinct point."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g, part in batch.groupby("grp"):
                reps = part["rep"].to_numpy()
                for i, near in cells.asked(g, _matrix(part["v"]), part["bound"].to_numpy()):
                    rows, columns = np.nonzero(near)
                    yield pd.DataFrame({"grp": g, "rep": reps[i + rows], "cell": columns.astype("int32")})

    return bounded(placed, cells, keep, tile).mapInPandas(run, "grp string, rep string, cell int")


def compared_share(placed: DataFrame, asked: DataFrame) -> DataFrame:
    """(grp, share): pairs that the search compares, over all pairs of distinct points and candidates."""
    held = placed.groupBy("grp", "cell").agg(F.count("*").alias("n"))
    done = asked.join(held, ["grp", "cell"]).groupBy("grp").agg(F.sum("n").alias("done"))
    every = placed.groupBy("grp").agg(F.count("*").alias("candidates"), F.count_if(F.col("id") == F.col("rep")).alias("targets"))
    return done.join(every, "grp").select("grp", (F.col("done") / (F.col("candidates") * F.col("targets"))).alias("share"))


def nearest(points: DataFrame, keep: int, tile: int = TILE) -> DataFrame:
    """(grp, id, peer, distance, rank): the ``keep`` nearest other points of each point (grp, id, v) of its group.

    ``id`` is unique in a group. Distances are rounded to nine places; equal ones are in
    order of id. A point of a smaller group has all others.
    """
    points = staged(points.select("grp", "id", "v"))
    wanted = keep + 1  # a point is among its own nearest
    members, candidates = dealt(points, wanted)
    placed, cells = celled(staged(candidates))
    known = staged(bounded(placed, cells, wanted, tile))
    blocks = cells.blocks(HELD * tile)
    block_of = {g: np.full(len(p), -1, dtype="int32") for g, p in cells.pivots.items()}
    for g, held in blocks.items():
        for k, (some, _) in enumerate(held):
            block_of[g][some] = k
    tiles_of = {g: np.array([n for _, n in held], dtype=int) for g, held in blocks.items()}

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g, part in batch.groupby("grp"):
                for i, near in cells.asked(g, _matrix(part["v"]), part["bound"].to_numpy()):
                    hit = np.stack([near[:, some].any(1) for some, _ in blocks[g]], axis=1)
                    rows, columns = np.nonzero(hit)
                    again = tiles_of[g][columns]
                    tile_ = np.concatenate([np.arange(n) for n in again]) if len(again) else again
                    yield part.iloc[np.repeat(i + rows, again)].assign(block=np.repeat(columns, again).astype("int32"), tile=tile_.astype("int32"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g, part in batch.groupby("grp"):
                yield part.assign(block=block_of[g][part["cell"].to_numpy()])[["grp", "id", "v", "cell", "block"]]

    # The tasks of a block: enough to keep a cluster busy where there is work, no more than TARGETS targets in one.
    n = F.col("n")
    chunks = F.greatest(F.ceil(n / TARGETS), F.least(F.lit(SPREAD), F.ceil(n / FEW))).cast("int").alias("chunks")
    shares = staged(known.groupBy("grp").agg(F.count("*").alias("n")).select("grp", chunks))
    shares = small(shares)
    counts = [(g, k, int(n)) for g, held in tiles_of.items() for k, n in enumerate(held)]
    tiles = F.broadcast(points.sparkSession.createDataFrame(counts, "grp string, block int, tiles int"))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    targets = known.mapInPandas(ask, "grp string, rep string, v array<double>, bound double, block int, tile int").join(shares, "grp").select("grp", "block", "tile", "rep", "v", "bound", deal("rep", "chunks").alias("chunk"))
    dealt_out = placed.mapInPandas(place, "grp string, id string, v array<double>, cell int, block int").join(tiles, ["grp", "block"]).join(shares, "grp")
    others = dealt_out.select("grp", "block", deal("id", "tiles").alias("tile"), F.col("id").alias("peer"), F.col("v").alias("w"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "cell")
    key = ["grp", "block", "tile", "chunk"]

    def search(some: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(some) and len(held):
            group, held = some["grp"].iloc[0], held.sort_values("peer")
            x, w, bound, cell = _matrix(some["v"]), _matrix(held["w"]), some["bound"].to_numpy(), held["cell"].to_numpy()
            reps, peers = some["rep"].to_numpy(), held["peer"].to_numpy()
            own = np.concatenate([_distances(x[i : i + AT_ONCE], cells.pivots[group]).argmin(1) for i in range(0, len(x), AT_ONCE)])
            order = np.argsort(own, kind="stable")
            x, bound, reps = x[order], bound[order], reps[order]
            for i, near in cells.asked(group, x, bound):
                at = np.flatnonzero(near.any(0)[cell])
                rows, columns, d = within(x[i : i + AT_ONCE], bound[i : i + AT_ONCE], w[at], wanted)
                found.append(pd.DataFrame({"grp": group, "rep": reps[i + rows], "peer": peers[at[columns]], "far": d}))
        return pd.concat(found) if found else pd.DataFrame({"grp": pd.Series([], dtype=object), "rep": pd.Series([], dtype=object), "peer": pd.Series([], dtype=object), "far": pd.Series([], dtype=float)})

    near = targets.groupBy(*key).cogroup(others.groupBy(*key)).applyInPandas(search, "grp string, rep string, peer string, far double")
    order = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("distance", "peer"))
    best = near.select("grp", "rep", "peer", F.round("far", 9).alias("distance")).withColumn("rank", order("grp", "rep")).where(F.col("rank") <= wanted).drop("rank")
    own = members.join(staged(best), ["grp", "rep"]).where("peer <> id")
    return own.withColumn("rank", order("grp", "id")).where(F.col("rank") <= keep).select("grp", "id", "peer", "distance", "rank")
