"""The outlier stage as SQL: seeding, turns of the centres, silhouette and forest, level by level.

Written from the definitions, with the numbers of the stage stated here once more.
"""

from __future__ import annotations

from fleetlens.operators.ml import FEATURES

# The stage's parameters.
SEED, RESTARTS, OVERSAMPLED, TURNS, K_MAX = 42, 10, 6, 25, 3
TREES, SUBSAMPLE, DRAWN, LEVELS, COHORT = 200, 256, 400, 8, 20

W = len(FEATURES)
Steps = dict[str, tuple[tuple[str, ...], str]]


def draw(*parts: str) -> str:
    return f"((CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8) AS BIGINT) + 0.5) / 4294967296.0)"


def square(a: str, b: str) -> str:
    return f"power(list_distance({a}, {b}), 2)"


def path(n: str) -> str:
    return f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1.0) + 0.5772156649015329) - 2 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"


def _features() -> Steps:
    med = ", ".join(f"median({f}) AS med_{f}" for f in FEATURES)
    fill = ", ".join(f"coalesce({f}, med_{f}, 0.0) AS {f}" for f in FEATURES)
    stats = ", ".join(f"avg({f}) AS mean_{f}, stddev_pop({f}) AS sd_{f}" for f in FEATURES)
    grid = ", ".join(f"floor(({f} - mean_{f}) / CASE WHEN sd_{f} > 1e-12 THEN sd_{f} ELSE 1.0 END * 1e6 + 0.5) / 1e6" for f in FEATURES)
    return {
        "o_fill": (("feat",), f"SELECT variant, imei, n_records, {fill} FROM feat JOIN (SELECT variant, {med} FROM feat GROUP BY 1) USING (variant)"),
        "o_z": (("o_fill",), f"SELECT variant, imei, n_records, cohort, [{grid}] AS x FROM o_fill JOIN (SELECT variant, count(*) AS cohort, {stats} FROM o_fill GROUP BY 1) USING (variant)"),
        "o_big": (("o_z",), f"SELECT variant, imei, cohort, x FROM o_z WHERE cohort >= {COHORT}"),
    }


def _clusters() -> Steps:
    out: Steps = {
        "o_c0": (("o_big",), f"SELECT variant, s, imei, x FROM (SELECT *, row_number() OVER (PARTITION BY variant, s ORDER BY {draw(str(SEED), 'imei', 's', '0')}, imei) AS k FROM o_big, (SELECT unnest(range({RESTARTS})) AS s)) WHERE k = 1"),
    }
    for turn in (1, 2):
        before = f"o_c{turn - 1}"
        out[f"o_d{turn}"] = (("o_big", before), f"SELECT b.variant, c.s, b.imei, b.x, min({square('b.x', 'c.x')}) AS d FROM o_big b JOIN {before} c ON b.variant = c.variant GROUP BY ALL")
        out[f"o_c{turn}"] = (
            (before, f"o_d{turn}"),
            f"SELECT variant, s, imei, x FROM {before} UNION ALL SELECT variant, s, imei, x FROM o_d{turn} JOIN (SELECT variant, s, sum(d) AS cost FROM o_d{turn} GROUP BY 1, 2) USING (variant, s) WHERE {draw(str(SEED), 'imei', 's', str(turn))} * cost < {OVERSAMPLED} * d",
        )
    out["o_w"] = (("o_big", "o_c2"), f"""SELECT c.variant, c.s, c.imei, c.x, coalesce(w, 0) AS w FROM o_c2 c LEFT JOIN (SELECT variant, s, own, count(*) AS w FROM
        (SELECT b.variant, c.s, b.imei, c.imei AS own, row_number() OVER (PARTITION BY b.variant, c.s, b.imei ORDER BY {square('b.x', 'c.x')}, c.imei) AS k FROM o_big b JOIN o_c2 c ON b.variant = c.variant) WHERE k = 1 GROUP BY 1, 2, 3) n
        ON n.variant = c.variant AND n.s = c.s AND n.own = c.imei""")
    out["o_p0"] = (("o_w",), "SELECT variant, s, 0 AS c, x FROM (SELECT *, row_number() OVER (PARTITION BY variant, s ORDER BY w DESC, imei) AS k FROM o_w) WHERE k = 1")
    for j in range(1, K_MAX):
        out[f"o_p{j}"] = ((f"o_p{j - 1}", "o_w"), f"""SELECT * FROM o_p{j - 1} UNION ALL SELECT variant, s, {j} AS c, x FROM (SELECT *, row_number() OVER (PARTITION BY variant, s ORDER BY v DESC, imei) AS k FROM
          (SELECT w.variant, w.s, w.imei, w.x, w.w * min({square('w.x', 'p.x')}) AS v FROM o_w w JOIN o_p{j - 1} p ON w.variant = p.variant AND w.s = p.s GROUP BY w.variant, w.s, w.imei, w.x, w.w)) WHERE k = 1""")
    out["o_m0"] = ((f"o_p{K_MAX - 1}", "o_big"), f"SELECT variant, k, s, c, x FROM o_p{K_MAX - 1} JOIN (SELECT variant, unnest(range(2, 1 + greatest(2, least({K_MAX}, count(*) // 5)))) AS k FROM o_big GROUP BY 1) USING (variant) WHERE c < k")
    mean = ", ".join(f"avg(x[{i}])" for i in range(1, W + 1))
    nearest = lambda m: f"SELECT variant, k, s, imei, x, c, d FROM (SELECT b.variant, m.k, m.s, b.imei, b.x, m.c, {square('b.x', 'm.x')} AS d, row_number() OVER (PARTITION BY b.variant, m.k, m.s, b.imei ORDER BY {square('b.x', 'm.x')}, m.c) AS r FROM o_big b JOIN {m} m ON b.variant = m.variant) WHERE r = 1"
    for t in range(TURNS):
        out[f"o_m{t + 1}"] = ((f"o_m{t}", "o_big"), f"SELECT o.variant, o.k, o.s, o.c, coalesce(n.x, o.x) AS x FROM o_m{t} o LEFT JOIN (SELECT variant, k, s, c, [{mean}] AS x FROM ({nearest(f'o_m{t}')}) GROUP BY 1, 2, 3, 4) n ON o.variant = n.variant AND o.k = n.k AND o.s = n.s AND o.c = n.c")
    out["o_end"] = ((f"o_m{TURNS}", "o_big"), nearest(f"o_m{TURNS}"))
    out["o_best"] = (("o_end",), "SELECT e.* FROM o_end e JOIN (SELECT variant, k, s FROM (SELECT *, row_number() OVER (PARTITION BY variant, k ORDER BY round(cost, 6), s) AS r FROM (SELECT variant, k, s, sum(d) AS cost FROM o_end GROUP BY 1, 2, 3)) WHERE r = 1) USING (variant, k, s)")
    out["o_sil"] = (("o_best",), """SELECT variant, k, avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b, 1e-12) WHEN b IS NOT NULL THEN 0.0 END) AS score FROM (SELECT variant, k, imei, max(n) FILTER (WHERE mine) AS n, max(far / greatest(n - 1, 1)) FILTER (WHERE mine) AS a, min(far / n) FILTER (WHERE NOT mine) AS b FROM
        (SELECT i.variant, i.k, i.imei, i.c = j.c AS mine, j.c, sum(list_distance(i.x, j.x)) AS far, count(*) AS n FROM o_best i JOIN o_best j ON i.variant = j.variant AND i.k = j.k GROUP BY ALL) GROUP BY 1, 2, 3) GROUP BY 1, 2""")
    out["o_cluster"] = (("o_best", "o_sil"), "SELECT variant, imei, c AS cluster_id, round(sqrt(d), 9) AS distance FROM o_best JOIN (SELECT variant, k FROM (SELECT *, row_number() OVER (PARTITION BY variant ORDER BY round(score, 9) DESC NULLS LAST, k) AS r FROM o_sil) WHERE r = 1) USING (variant, k)")
    return out


def _forest() -> Steps:
    low, high = (", ".join(f"{f}(x[{i}])" for i in range(1, W + 1)) for f in ("min", "max"))
    out: Steps = {
        "o_draw": (("o_big",), f"SELECT variant, tree, x FROM (SELECT *, row_number() OVER (PARTITION BY variant, tree ORDER BY chance, imei) AS k FROM (SELECT *, {draw(str(SEED), 'imei', chr(39) + 'tree' + chr(39), 'tree')} AS chance FROM o_big, (SELECT unnest(range({TREES})) AS tree)) WHERE chance * cohort < {DRAWN}) WHERE k <= {SUBSAMPLE}"),
        "o_t0": (("o_draw",), "SELECT variant, tree, CAST(1 AS BIGINT) AS node, x, ceil(log2(greatest(count(*) OVER (PARTITION BY variant, tree), 2))) AS top FROM o_draw"),
        "o_v0": (("o_big",), f"SELECT variant, imei, x, tree, CAST(1 AS BIGINT) AS node FROM o_big, (SELECT unnest(range({TREES})) AS tree)"),
    }
    child = "2 * node + CASE WHEN x[f] < cut THEN 0 ELSE 1 END"
    for d in range(LEVELS + 1):
        pick = lambda what: draw(str(SEED), "tree", "node", f"'{what}'")
        out[f"o_n{d}"] = ((f"o_t{d}",), f"""SELECT variant, tree, node, f, lo[f] + {pick('cut')} * (hi[f] - lo[f]) AS cut, CASE WHEN f IS NULL THEN {d} + {path('n')} END AS path FROM
          (SELECT *, CASE WHEN {d} < top AND n > 1 AND len(free) > 0 THEN free[1 + CAST(floor({pick('feature')} * len(free)) AS INT)] END AS f FROM
            (SELECT *, list_filter(range(1, {W + 1}), lambda i: hi[i] > lo[i]) AS free FROM (SELECT variant, tree, node, any_value(top) AS top, count(*) AS n, [{low}] AS lo, [{high}] AS hi FROM o_t{d} GROUP BY 1, 2, 3)))""")
        if d < LEVELS:
            for table, keys in (("o_t", "variant, tree, x, top"), ("o_v", "variant, imei, x, tree")):
                out[f"{table}{d + 1}"] = ((f"{table}{d}", f"o_n{d}"), f"SELECT {keys}, {child} AS node FROM {table}{d} JOIN o_n{d} USING (variant, tree, node) WHERE f IS NOT NULL")
    leaves = " UNION ALL ".join(f"SELECT variant, imei, path FROM o_v{d} JOIN o_n{d} USING (variant, tree, node) WHERE f IS NULL" for d in range(LEVELS + 1))
    out["o_iso"] = (("o_big", *[f"o_v{d}" for d in range(LEVELS + 1)], *[f"o_n{d}" for d in range(LEVELS + 1)]), f"SELECT variant, imei, round(power(2.0, -(sum(path) / {TREES}) / greatest({path(f'least({SUBSAMPLE}, any_value(cohort))')}, 1e-9)), 9) AS iso FROM ({leaves}) JOIN o_big USING (variant, imei) GROUP BY 1, 2")
    return out


def steps() -> Steps:
    """The common table expressions of the stage; ``oflags`` has its result."""
    zero = lambda c, v: f"coalesce({c}, {v}) AS {c}"
    far, odd = "round(distance, 9) >= round(far, 9)", "round(iso, 9) > round(odd, 9)"
    return {
        **_features(), **_clusters(), **_forest(),
        "o_mark": (("o_cluster", "o_iso"), f"""SELECT variant, imei, cluster_id, round_even(distance, 4) AS distance_to_center, round_even(iso, 4) AS isolation_score, {far} AS cluster_outlier, {odd} AS isolation_outlier,
          ({far} OR {odd}) AS is_anomaly, CAST({far} AS INT) + CAST({odd} AS INT) AS severity_tier FROM o_cluster JOIN o_iso USING (variant, imei)
          JOIN (SELECT variant, quantile_cont(distance, 0.9) AS far, quantile_cont(iso, 0.9) AS odd FROM o_cluster JOIN o_iso USING (variant, imei) GROUP BY 1) USING (variant)"""),
        "oflags": (("o_z", "o_mark"), f"""SELECT variant, imei, {zero('is_anomaly', 'false')}, {zero('isolation_score', '0.0')}, {zero('distance_to_center', '0.0')}, CAST(coalesce(cluster_id, 0) AS INT) AS cluster_id, {zero('cluster_outlier', 'false')}, {zero('isolation_outlier', 'false')},
          CASE coalesce(severity_tier, 0) WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity, {zero('severity_tier', '0')}, n_records FROM o_z LEFT JOIN o_mark USING (variant, imei)"""),
    }
