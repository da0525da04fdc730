"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union-find.

Documents become sets of word shingles; equal sets are one node. SuperMinHash (Ertl
2017) draws a correlated permutation of registers for each element and stops once
every register holds a smaller step; its signatures vary less than MinHash's. Bands
of registers are bucket keys. Links are confirmed on full sets, groups come from
union-find inside partitions and contraction across them.

Buckets never emit all their pairs. Buckets are split by set size, since linked sets
differ little in size. In each of TURNS turns a member is compared with one pivot
at most: over its buckets that still hold several groups, the member that meets most
others, later a random one. So candidate links of a turn are no more than members.
After that, only pairs of different groups in one bucket are open. Rare shingles
decide those: pairs that share one are listed from its short postings and stay where
their number and the common shingles allow a link; sets whose common shingles alone
allow one meet inside tasks, in tiles, of which only links between groups come back.

Defined results: a NULL or empty text, or one without words, is an empty set, linked
with nothing; a text shorter than a shingle is one shingle; repeated rows and equal
texts share a group; a row with a NULL key is named by the least key of its group,
if any; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import checkpointed, remove, serving, written

#: Bands and registers of a band: at similarity 0.8 a pair shares no band once in a million.
BANDS, ROWS = 26, 4
REGISTERS = BANDS * ROWS
#: Share of equal registers under which a pair is not verified: five standard deviations below 0.8.
LEAST_AGREEMENT = 0.6
#: Words a worker remembers the hash of.
MEMO_WORDS = 100_000
#: Rows of a batch that a worker returns.
CHUNK_ROWS = 256
#: Keys up to which a list of them is broadcast; beyond it both sides are shuffled.
BROADCAST_KEYS = 500_000
#: Open sets that may hold a shingle that still counts as rare.
RARE = 64
#: Edges that one union-find may end with: some 100 MB of a worker.
FEW_EDGES = 500_000
#: Shingles of a tile of sets that are compared inside tasks; below that, tiles of a block for parallel work unless they would have few.
TILE_SHINGLES, SPREAD, FEW_SHINGLES = 1 << 19, 12, 1 << 15
#: Turns in which each member of an open bucket is compared with one pivot, before pairs are decided.
TURNS = 3
#: Linked sets differ in size by a factor of 1.25 at most; a little more for rounding.
SIZE_STEP = 1.26

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        self[word] = value = value - (1 << 64) if value >> 63 else value
        return value


_hashes = _WordHashes()


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; A-Z count as a-z."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.array(list(map(_hashes.__getitem__, words)), dtype=np.int64).view(np.uint64)
    width = min(size, len(h))
    count = len(h) - width + 1
    out = np.full(count, width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = _mix(out * _GOLDEN + h[i : i + count])
    return np.unique(out)


def signature(elements: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash of a set of 64-bit hashes, all elements one step at a time.

    Step j gives each element the register at place j of its own Fisher-Yates
    permutation, with the value (j, random). Values of later steps are greater, so
    the loop ends when every register has a value of an earlier step.
    """
    m = registers
    best = np.full(m, np.iinfo(np.int64).max, dtype=np.int64)
    place = None
    rows = np.arange(len(elements))
    for j in range(m):
        with np.errstate(over="ignore"):
            draw = _mix(elements + np.uint64(j + 1) * _GOLDEN)
        k = (j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)
        if j == 0:
            register = k
        else:
            if place is None:  # the first swap, done late: most large sets end at step 0
                place = np.tile(np.arange(m, dtype=np.uint16), (len(elements), 1))
                place[rows, first] = 0
                place[:, 0] = first
            register = place[rows, k].astype(np.int64)
            place[rows, k] = place[:, j]
        if j == 0:
            first = k
        np.minimum.at(best, register, (draw >> np.uint64(32)).astype(np.int64) + (j << 32))
        if int(best.max()) >> 32 <= j:
            break
    return best


def text_digest(text: str | Column) -> Column:
    """What tells rows of one key apart: equal for equal texts only; NULL for NULL."""
    return F.md5(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"))


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, digest, n, node, sig) of every row of (doc_id, text)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        serving("near duplicates", _hashes.clear)
        for part in parts:
            for i in range(0, len(part), CHUNK_ROWS):
                chunk = part.iloc[i : i + CHUNK_ROWS]
                rows = []
                for text in chunk["text"]:
                    s = shingles(text, size)
                    if len(s):
                        sig = signature(s)
                        # 32 bits of a register: the random part, stirred with the step.
                        short = (sig ^ (sig >> 32) * 0x9E3779B1).astype(np.uint32).view(np.int32)
                        rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), short))
                    else:
                        rows.append((0, None, None))
                out = pd.DataFrame(rows, columns=["n", "node", "sig"])
                out.insert(0, "doc_id", chunk["doc_id"].to_numpy())
                out.insert(1, "digest", chunk["digest"].to_numpy())
                yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_digest("text").alias("digest")).mapInPandas(run, f"doc_id {kind}, digest string, n long, node binary, sig array<int>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(node, members) of every row with a text; small batches, since sets are long."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        serving("near duplicates", _hashes.clear)
        for part in parts:
            for i in range(0, len(part), CHUNK_ROWS):
                sets = [shingles(text, size) for text in part["text"].iloc[i : i + CHUNK_ROWS]]
                yield pd.DataFrame({"node": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "members": [s.view(np.int64) for s in sets]})

    return docs.select("text").mapInPandas(run, "node binary, members array<long>")


def local_union_find(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (a, b) of one partition to a spanning star for each local group."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for part in pairs:
        for a, b in zip(part["a"].tolist(), part["b"].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    stars = [(root(x), x) for x in list(parent)]
    yield pd.DataFrame([s for s in stars if s[0] != s[1]], columns=["a", "b"], dtype="int64")


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(id, label) of every id in ``edges`` (a, b): the label is one id of its group.

    Each turn reduces every partition by union-find, points each vertex at its first
    neighbour in a random order of the turn, follows that twice, and contracts. A random
    order leaves a constant share of the vertices of any graph, so turns grow with the
    logarithm of its size, chains of ordered ids included. Nothing is collected; the
    last ``few`` edges at most end in one task.
    """
    spark = edges.sparkSession
    tidy = lambda e: e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).mapInPandas(local_union_find, "a long, b long").distinct()
    edges, edges_at = written(tidy(edges))
    labels, labels_at = written(edges.select("a").union(edges.select("b")).distinct().select(F.col("a").alias("id"), F.col("a").alias("label")))
    turn = 0
    while (left := edges.limit(few + 1).count()) > few:
        rank = lambda v: F.struct(F.xxhash64(F.lit(turn), v).alias("h"), F.col(v).alias("v"))  # noqa: B023, E731
        both = edges.select("a", "b").union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("x"), F.least("m", rank("a"))["v"].alias("y"))
        hop = first.select(F.col("x").alias("y"), F.col("y").alias("z"))
        point = _small(checkpointed(first.join(hop, "y").select("x", F.col("z").alias("y"))))
        new_labels, new_labels_at = written(labels.join(point, F.col("label") == F.col("x"), "left").select("id", F.coalesce("y", "label").alias("label")))
        ends = edges.join(point, F.col("a") == F.col("x")).select(F.col("y").alias("a"), "b")
        new_edges, new_edges_at = written(tidy(ends.join(point, F.col("b") == F.col("x")).select("a", F.col("y").alias("b"))))
        remove(spark, labels_at)
        remove(spark, edges_at)
        (labels, labels_at), (edges, edges_at) = (new_labels, new_labels_at), (new_edges, new_edges_at)
        turn += 1
    if left:
        star = edges.coalesce(1).mapInPandas(local_union_find, "a long, b long")
        point = _small(checkpointed(star.select(F.col("b").alias("x"), F.col("a").alias("y"))))
        last_at, (labels, _) = labels_at, written(labels.join(point, F.col("label") == F.col("x"), "left").select("id", F.coalesce("y", "label").alias("label")))
        remove(spark, last_at)
    remove(spark, edges_at)
    return labels


def _agreement(a: str, b: str) -> str:
    """SQL for the number of equal registers of two signatures."""
    return f"size(filter(zip_with({a}, {b}, (r, s) -> r = s), e -> e))"


def _small(ids: DataFrame) -> DataFrame:
    """``ids`` with a broadcast hint where a count shows that they are few; staged or cheap tables only."""
    return F.broadcast(ids) if ids.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else ids


def _confirm(pairs: DataFrame, sig: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= 80 * union, decided on full sets."""
    near = (
        pairs.join(sig.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a")
        .join(sig.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b")
        .where("100 * least(na, nb) >= 80 * greatest(na, nb)")
        .where(f"{_agreement('sa', 'sb')} >= {LEAST_AGREEMENT * REGISTERS}")
        .select("a", "b", "na", "nb")
    )
    near = checkpointed(near)
    ids = checkpointed(near.select(F.col("a").alias("id")).union(near.select("b")).distinct())
    full = sets.join(_small(ids), "id", "left_semi")
    return (
        near.join(full.select(F.col("id").alias("a"), F.col("members").alias("ma")), "a")
        .join(full.select(F.col("id").alias("b"), F.col("members").alias("mb")), "b")
        .withColumn("both", F.size(F.array_intersect("ma", "mb")))
        .where("100 * both >= 80 * (na + nb - both)")
        .select("a", "b")
    )


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, label) after new ``links`` (a, b) between ids."""
    at = lambda end: labels.select(F.col("id").alias(end), F.col("label").alias(f"l{end}"))
    more = links.join(at("a"), "a", "left").join(at("b"), "b", "left")
    merged = components(more.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    # One label may hold a third of all sets: the renaming is broadcast, or the join split where skewed.
    renamed = _small(checkpointed(merged.select(F.col("id").alias("label"), F.col("label").alias("to"))))
    kept = labels.join(renamed, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    return written(kept.union(merged.join(labels, "id", "left_anti").select("id", "label")))[0]


def _candidate_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, members) of candidate nodes, from one row of each."""
    keys = wanted.select(F.col("rep").alias("_rep"), "id", F.col("node").alias("_node"))
    ids = _small(keys.select("_rep").distinct())
    made = _sets(docs.join(ids, docs.doc_id.eqNullSafe(ids["_rep"]), "left_semi"), size)
    nodes = _small(keys.select("id", "_node"))
    found = checkpointed(made.join(nodes, made.node == nodes["_node"]).select("id", "members"))
    # Repeated rows of one key and text give a node twice.
    return found if found.count() == wanted.count() else checkpointed(found.dropDuplicates(["id"]))


def _named(narrow: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and (node, component_id, keeper) of every set.

    The keeper is the least (key, text digest) of the group; NULL keys come last.
    """
    sketched = checkpointed(_sketches(narrow, size))
    nodes = checkpointed(
        sketched.where("n > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    labels = _labels(narrow, nodes, size)
    linked = nodes.join(labels, "id")
    names = checkpointed(linked.groupBy("label").agg(F.min("rep").alias("component_id"), F.min("least").alias("keeper")))
    heads = labels.join(_small(names), "label").select("id", "component_id", "keeper")
    found = nodes.join(heads, "id", "left")
    return sketched, found.select("node", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("keeper", "least").alias("keeper"))


def near_duplicate_groups(docs: DataFrame, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least key of the group)."""
    sketched, named = _named(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), size)
    return sketched.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named.drop("keeper"), "node", "left").select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def surplus_rows(docs: DataFrame, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, kept) of rows that are not the only ones to stay of their group.

    ``kept`` is false where all rows of the key and text go, and true where they are
    the keeper of their group but stand in the table more than once.
    """
    sketched, named = _named(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), size)
    is_keeper = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("digest") == F.col("keeper.digest"))
    judged = sketched.select("doc_id", "digest", "node").join(named.drop("component_id"), "node").select("doc_id", "digest", is_keeper.alias("kept"))
    return judged.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count("*").alias("c")).where("not kept or c > 1").drop("c")


def tile_links(some: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between sets (id, label, members) of two tiles that join their labels; no more than labels."""
    out: list[tuple[int, int]] = []
    if len(some) and len(held):
        sizes = held["members"].map(len).to_numpy()
        every = np.concatenate(held["members"].to_list())
        order = np.argsort(every, kind="stable")
        every, owner = every[order], np.repeat(np.arange(len(held)), sizes)[order]
        ids, labels = held["id"].to_numpy(), held["label"].to_numpy()
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for id_, label, members in zip(some["id"].tolist(), some["label"].tolist(), some["members"]):
            first = np.searchsorted(every, members, side="left")
            count = np.searchsorted(every, members, side="right") - first
            at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            both = np.bincount(owner[at], minlength=len(held))
            for k in np.flatnonzero((100 * both >= 80 * (len(members) + sizes - both)) & (labels != label)).tolist():
                x, y = root(label), root(int(labels[k]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((id_, int(ids[k])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _links_in_tiles(alive: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different labels of sets that share a key of ``alive`` (key, id, n, label, main).

    Staged. Sets that keys connect are a block; each travels to the tiles of its block, and those
    outside the largest label of a key meet all others there. Pairs are never rows.
    """
    leads = alive.groupBy("key").agg(F.min("id").alias("a"))
    blocks = components(alive.join(leads, "key").select("a", F.col("id").alias("b"))).withColumnRenamed("label", "block")
    one = alive.groupBy("id").agg(F.first("n").alias("n"), F.first("label").alias("label"), F.max(F.col("label") != F.col("main")).alias("outside"))
    dealt = checkpointed(one.join(_small(blocks), "id"))
    tiles = lambda n: F.greatest(F.ceil(n / TILE_SHINGLES), F.least(F.lit(SPREAD), F.ceil(n / FEW_SHINGLES))).cast("int")
    sizes = dealt.groupBy("block").agg(tiles(F.sum("n")).alias("tiles"), tiles(F.sum(F.when(F.col("outside"), F.col("n")))).alias("chunks")).where("chunks > 0")
    full = dealt.join(_small(checkpointed(sizes)), "block").join(sets, "id").select("block", "id", "label", "members", "outside", "tiles", "chunks")
    deal = lambda n: F.pmod(F.xxhash64(F.lit(n), "id"), F.col(n)).cast("int").alias(n[:-1])
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(n[:-1])
    key = ["block", "tile", "chunk"]
    some = full.where("outside").select("block", "id", "label", "members", deal("chunks"), each("tiles"))
    held = full.select(*[F.col(c).alias(c) for c in ("block", "id", "label", "members")], deal("tiles"), each("chunks"))
    # Staged: the union-find that follows would else run in the same tasks, with a second Python worker for each, which stays.
    return checkpointed(some.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(tile_links, "a long, b long"))


def _labels(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    bands = F.array(*[F.xxhash64(F.lit(b), *[F.col("sig")[b * ROWS + r] for r in range(ROWS)]) for b in range(BANDS)])
    entries = nodes.select("id", "n", F.explode(bands).alias("bucket"))
    shared = checkpointed(entries.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1").select("bucket"))
    step = F.floor(F.log("n") / F.log(F.lit(SIZE_STEP)))
    sized = entries.join(_small(shared), "bucket").select("id", "n", F.explode(F.array(F.xxhash64("bucket", step), F.xxhash64("bucket", step + 1))).alias("key"))
    met = checkpointed(sized.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    members = checkpointed(sized.join(met, "key").select("key", "id", "n", F.col("id").alias("label")))

    meets = checkpointed(members.join(met, "key").groupBy("id").agg(F.sum("c").alias("degree")))
    wanted = checkpointed(nodes.join(meets.select("id"), "id"))
    sets = _candidate_sets(docs, wanted, size)
    facts = wanted.select("id", "n", "sig")
    labels = checkpointed(facts.select("id", F.col("id").alias("label")).limit(0))
    opened = members
    for turn in range(TURNS):
        # First the member that meets most others, then random ones.
        rank = F.col("degree") if turn == 0 else F.lit(0)
        pivots = checkpointed(opened.join(meets, "id").groupBy("key").agg(F.max(F.struct(rank, F.xxhash64(F.lit(turn), "id"), "id", "label")).alias("p")))
        choice = opened.join(pivots, "key").where("label <> p.label").groupBy("id").agg(F.max("p").alias("p"))
        pairs = choice.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct()
        labels = _merged(labels, _confirm(pairs, facts, sets))
        named = members.select("key", "id", "n").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        split = checkpointed(named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key"))
        opened = checkpointed(named.join(split, "key"))
        if opened.isEmpty():
            return labels
    # A shingle of at most RARE open sets is rare. Sets that share no rare shingle share at
    # most the common ones of either; a link of sizes n and m shares 4 / 9 of n + m or more.
    spread = sets.join(opened.select("id").distinct(), "id", "left_semi").select("id", F.explode("members").alias("x"))
    rare = checkpointed(spread.groupBy("x").agg(F.count("*").alias("c"), F.min("id").alias("one")).where(F.col("c") <= RARE))
    shared = rare.where("c > 1").select("x")
    places = checkpointed(spread.join(_small(shared), "x", "left_semi"))
    owners = rare.where("c = 1").select(F.col("one").alias("id")).union(places.select("id")).groupBy("id").agg(F.count("*").alias("rare"))
    bound = opened.join(owners, "id", "left").withColumn("common", F.col("n") - F.coalesce("rare", F.lit(0)))
    main = bound.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "label")).alias("m"))
    least = bound.groupBy("key").agg(F.min("n").alias("least_n"))
    placed = checkpointed(bound.join(main.select("key", F.col("m.label").alias("main")), "key").join(least, "key"))
    apart = "x.label <> y.label and 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)"
    # Sharing common shingles only: sets of a key are compared in tiles.
    alive = checkpointed(placed.where("9 * common >= 4 * (n + least_n)"))
    by_common = _links_in_tiles(alive, sets)
    # Sharing a rare shingle: its postings are bounded by RARE, and a pair shares no more than it shares rare ones and the lesser has common ones.
    who = placed.groupBy("id").agg(F.first("n").alias("n"), F.first("common").alias("common"), F.first("label").alias("label"), F.max(F.col("label") != F.col("main")).alias("outside"))
    posted = places.select(F.col("x").alias("shingle"), "id").join(who, "id")
    met_once = f"{apart} and (x.id < y.id or not y.outside)"
    by_rare = (
        posted.where("outside").alias("x").join(posted.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & F.expr(met_once))
        .groupBy(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .agg(F.count("*").alias("rare"), F.first(F.least("x.common", "y.common")).alias("common"), F.first(F.expr("x.n + y.n")).alias("n"))
        .where("9 * (rare + common) >= 4 * n")
        .select("a", "b")
    )
    return _merged(labels, _confirm(by_rare, facts, sets).union(by_common))
