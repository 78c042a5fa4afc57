"""k-means, mean shift, Gaussian mixtures and self-organising maps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.blocks import to_matrix
from vectable.functions.hashing import normal_sql, row_hash_sql, uniform_sql
from vectable.operators import clustering as cl, mixture as gm, som
from vectable.operators.neighbors import fit_cells
from vectable.operators.order import sample_rows
from vectable.plans.common import LINEITEM_KEY, Catalog, embeddings, lineitem, rnd, rnd_sql, table

catalog = Catalog()

SEED = 5
DIM = 64


def _start(e: DataFrame, k: int) -> np.ndarray:
    return to_matrix(sample_rows(e, k, "vec_id", SEED).select("features").toArrow()["features"])


def _start_sql(k: int) -> str:
    return (
        f"c0 AS (SELECT (row_number() OVER (ORDER BY {row_hash_sql('vec_id', SEED)}, vec_id) - 1)::INT AS node, "
        f"embedding::DOUBLE[] AS w FROM embeddings QUALIFY node < {k})"
    )


def _lloyd_sql(steps: int, c0: str, empty: str = "kill") -> str:
    """CTEs a1, c1 .. of that many Lloyd steps after c0(node, w)."""
    parts = ["e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)", c0]
    for i in range(steps):
        parts.append(
            f"a{i + 1} AS (SELECT vec_id, any_value(v) AS v, arg_min(node, (list_distance(v, w), node)) AS node FROM e, c{i} GROUP BY vec_id)"
        )
        parts.append(
            f"m{i + 1} AS (SELECT node, list(x ORDER BY j) AS w, any_value(n) AS n FROM (SELECT node, j, avg(x) AS x, count(*) AS n FROM "
            f"(SELECT node, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM a{i + 1}) GROUP BY node, j) GROUP BY node)"
        )
        if empty == "kill":
            parts.append(f"c{i + 1} AS (SELECT (row_number() OVER (ORDER BY node) - 1)::INT AS node, w, n FROM m{i + 1})")
        else:
            parts.append(
                f"c{i + 1} AS (SELECT c.node, coalesce(m.w, c.w) AS w, coalesce(m.n, 0) AS n FROM c{i} c LEFT JOIN m{i + 1} m USING (node))"
            )
    return "WITH " + ", ".join(parts)


CENTROIDS = f"SELECT node AS cluster, n, {rnd_sql('w[1]')} AS first, {rnd_sql('list_sum(w)')} AS total FROM c"


def _centroid_rows(spark: SparkSession, m: cl.KMeansModel) -> DataFrame:
    rows = [(i, int(m.counts[i]), float(w[0]), float(w.sum())) for i, w in enumerate(m.centroids)]
    df = spark.createDataFrame(rows, "cluster int, n bigint, first double, total double")
    return df.withColumn("first", rnd("first")).withColumn("total", rnd("total"))


@catalog.query(_lloyd_sql(3, _start_sql(8)) + CENTROIDS.replace("FROM c", "FROM c3"))
def kmeans_fixed_start_3_steps(spark: SparkSession, sf: str) -> DataFrame:
    return _centroid_rows(spark, cl.kmeans(embeddings(spark, sf), 8, max_iterations=3, id_col="vec_id", seed=SEED))


FAR = "c0 AS (SELECT node, w FROM s UNION ALL SELECT 8, list_transform(range(64), lambda x: 100.0::DOUBLE))"


def _with_far(e: DataFrame) -> np.ndarray:
    return np.vstack([_start(e, 8), np.full((1, DIM), 100.0)])


@catalog.query(_lloyd_sql(2, _start_sql(8).replace("c0 AS", "s AS", 1) + ", " + FAR) + CENTROIDS.replace("FROM c", "FROM c2"))
def kmeans_empty_kill(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    return _centroid_rows(spark, cl.kmeans(e, 9, centroids=_with_far(e), max_iterations=2))


@catalog.query(_lloyd_sql(2, _start_sql(8).replace("c0 AS", "s AS", 1) + ", " + FAR, "allow") + CENTROIDS.replace("FROM c", "FROM c2"))
def kmeans_empty_allow(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    return _centroid_rows(spark, cl.kmeans(e, 9, centroids=_with_far(e), max_iterations=2, empty="allow"))


@catalog.query(_lloyd_sql(4, _start_sql(8)) + CENTROIDS.replace("FROM c", "FROM c4"))
def kmeans_warm_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Two steps, then two more from the stored centroids."""
    e = embeddings(spark, sf)
    first = cl.kmeans(e, 8, max_iterations=2, id_col="vec_id", seed=SEED)
    return _centroid_rows(spark, cl.kmeans(e, len(first.centroids), centroids=first.centroids, max_iterations=2))


LABEL_START = (
    "c0 AS (SELECT label AS node, list(x ORDER BY j) AS w FROM (SELECT label, j, avg(x) AS x FROM (SELECT label, generate_subscripts(v, 1) AS j, "
    "unnest(v) AS x FROM e) GROUP BY label, j) GROUP BY label)"
)


@catalog.query(_lloyd_sql(2, LABEL_START) + CENTROIDS.replace("FROM c", "FROM c2"))
def kmeans_warm_assignments(spark: SparkSession, sf: str) -> DataFrame:
    return _centroid_rows(spark, cl.kmeans(embeddings(spark, sf), 10, assignments_col="label", max_iterations=2))


@catalog.query(_lloyd_sql(3, _start_sql(8)) + " SELECT vec_id, arg_min(node, (list_distance(v, w), node)) AS cluster FROM e, c3 GROUP BY vec_id")
def kmeans_assign(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    m = cl.kmeans(e, 8, max_iterations=3, id_col="vec_id", seed=SEED)
    return cl.assign(e, m.centroids).select("vec_id", "cluster")


SAMPLED = 3


def _sampled_sql(share: float, k: int) -> str:
    """One step of several samplings from given starts: counts and sums by sampling and centroid."""
    draws = ", ".join(f"{uniform_sql(SEED, s, 'vec_id')} < {share!r}" for s in range(SAMPLED))
    return (
        f"WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, [{draws}] AS member FROM embeddings), "
        f"s AS (SELECT row_number() OVER (ORDER BY {row_hash_sql('vec_id', SEED)}, vec_id) - 1 AS place, v AS w FROM e QUALIFY place < {SAMPLED * k}), "
        f"c AS (SELECT (place // {k})::INT AS run, (place % {k})::INT AS node, w FROM s), "
        "p AS (SELECT c.run, vec_id, any_value(v) AS v, arg_min(node, (list_distance(v, w), node)) AS node FROM e JOIN c ON e.member[c.run + 1] GROUP BY c.run, vec_id) "
        f"SELECT run, node, count(*) AS n, {rnd_sql('sum(v[1])')} AS first, {rnd_sql('sum(list_sum(v))')} AS total FROM p GROUP BY run, node"
    )


@catalog.query(_sampled_sql(0.2, 4))
def kmeans_refined_step(spark: SparkSession, sf: str) -> DataFrame:
    """One step of three samplings side by side, over their members alone."""
    e = embeddings(spark, sf)
    starts = cl.sampled_starts(e, 4, SAMPLED, "vec_id", SEED)
    sums, _ = cl.sampled_step(cl.memberships(e, SAMPLED, 0.2, "vec_id", SEED), starts)
    rows = [(r, c, int(t[-1]), float(t[0]), float(t[:-1].sum())) for r, run in enumerate(sums) for c, t in enumerate(run) if t[-1]]
    df = spark.createDataFrame(rows, "run int, node int, n bigint, first double, total double")
    return df.select("run", "node", "n", rnd("first").alias("first"), rnd("total").alias("total"))


@catalog.query()
def kmeans_refined(spark: SparkSession, sf: str) -> DataFrame:
    """A refined start with the operator's defaults: 100 samplings of two percent."""
    return _centroid_rows(spark, cl.kmeans(embeddings(spark, sf), 5, refined=True, id_col="vec_id"))


RADIUS = 1.0


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as (nation, balance in thousands)."""
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("row_id"), F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal") / 1000.0).alias("features"))


@catalog.query(
    "WITH p AS (SELECT c_nationkey::DOUBLE AS a, c_acctbal / 1000.0 AS b FROM customer), s AS (SELECT DISTINCT floor(a) AS sa, floor(b) AS sb FROM p) "
    f"SELECT sa AS seed_x, sb AS seed_y, count(*)::BIGINT AS n, {rnd_sql('avg(a)', 9)} AS x, {rnd_sql('avg(b)', 9)} AS y FROM s JOIN p "
    "ON (a - sa) * (a - sa) + (b - sb) * (b - sb) <= 1.0 GROUP BY sa, sb"
)
def meanshift_one_step(spark: SparkSession, sf: str) -> DataFrame:
    df = _balances(spark, sf)
    distinct = cl.distinct_points(df)
    cells, points = fit_cells(distinct, distinct.count(), 1)
    seeds = cl.bin_seeds(df, RADIUS)
    moved = cl.shift_once(seeds, cells, points, RADIUS).join(seeds, "_q")
    at = [F.get("_qx", F.lit(i)).alias(n) for i, n in enumerate(("seed_x", "seed_y"))]
    to = [rnd(F.get("center", F.lit(i)), 9).alias(n) for i, n in enumerate(("x", "y"))]
    return moved.select(*at, F.col("count").cast("bigint").alias("n"), *to)


@catalog.query(
    "WITH p AS (SELECT c_custkey, c_nationkey::DOUBLE AS a, c_acctbal / 1000.0 AS b FROM customer), "
    "d AS (SELECT p.c_custkey, sqrt((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b)) AS dist FROM p, p q WHERE p.c_custkey <> q.c_custkey), "
    "r AS (SELECT c_custkey, dist, row_number() OVER (PARTITION BY c_custkey ORDER BY dist) AS rank FROM d) "
    f"SELECT {rnd_sql('avg(dist)')} AS radius FROM r WHERE rank = (SELECT floor(0.2 * count(*)) FROM customer)"
)
def meanshift_radius(spark: SparkSession, sf: str) -> DataFrame:
    """The default radius: mean distance to the nearest fifth of all other points, over all points."""
    return spark.range(1).select(rnd(F.lit(cl.estimate_radius(_balances(spark, sf)))).alias("radius"))


@catalog.query()
def meanshift_fit(spark: SparkSession, sf: str) -> DataFrame:
    df = _balances(spark, sf)
    m = cl.mean_shift(df, 2.5, force_convergence=True)
    sizes = cl.mean_shift_assign(df, m).groupBy("cluster").agg(F.count("*").alias("n"))
    return sizes.join(m.centroids.select("cluster", rnd(F.get("features", F.lit(0))).alias("x"), rnd(F.get("features", F.lit(1))).alias("y")), "cluster")


# Mixture over (quantity, price in thousands) with given parameters.
WEIGHTS = (0.3, 0.3, 0.4)
MEANS = ((12.0, 20.0), (30.0, 50.0), (40.0, 80.0))
VARS = ((60.0, 150.0), (80.0, 200.0), (50.0, 180.0))
MIX = gm.Mixture(np.array(WEIGHTS), np.array(MEANS), np.array(VARS))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(*LINEITEM_KEY, F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000.0).alias("features"))


def _density(c: int, x: str = "l_quantity", y: str = "l_extendedprice / 1000.0") -> str:
    (mx, my), (vx, vy) = MEANS[c], VARS[c]
    return (
        f"ln({WEIGHTS[c]}) - 0.5 * (2 * ln(2 * pi()) + ln({vx}::DOUBLE) + ln({vy}::DOUBLE) + ({x} - {mx}) * ({x} - {mx}) / {vx}::DOUBLE "
        f"+ ({y} - {my}) * ({y} - {my}) / {vy}::DOUBLE)"
    )


KEY = ", ".join(LINEITEM_KEY)
DENSITIES = f"d AS (SELECT {KEY}, l_quantity AS x, l_extendedprice / 1000.0 AS y, " + ", ".join(f"{_density(c)} AS d{c}" for c in range(3)) + " FROM lineitem)"
LSE = "greatest(d0, d1, d2) + ln(exp(d0 - greatest(d0, d1, d2)) + exp(d1 - greatest(d0, d1, d2)) + exp(d2 - greatest(d0, d1, d2)))"


@catalog.query(f"WITH {DENSITIES} SELECT {KEY}, {rnd_sql(LSE)} AS log_prob, {rnd_sql(f'exp({LSE})', 9)} AS prob FROM d")
def gmm_logprob(spark: SparkSession, sf: str) -> DataFrame:
    s = gm.score(_pairs(spark, sf), MIX)
    return s.select(*LINEITEM_KEY, rnd("log_prob").alias("log_prob"), rnd(F.exp("log_prob"), 9).alias("prob"))


@catalog.query(
    f"WITH {DENSITIES} SELECT {KEY}, (CASE WHEN d0 >= d1 AND d0 >= d2 THEN 0 WHEN d1 >= d2 THEN 1 ELSE 2 END)::INT AS component FROM d"
)
def gmm_classify(spark: SparkSession, sf: str) -> DataFrame:
    return gm.classify(_pairs(spark, sf), MIX).select(*LINEITEM_KEY, "component")


@catalog.query(
    f"WITH {DENSITIES}, l AS (SELECT x, y, unnest([0, 1, 2])::INT AS component, unnest([exp(d0 - ({LSE})), exp(d1 - ({LSE})), exp(d2 - ({LSE}))]) AS r, "
    f"{LSE} AS ll FROM d), n AS (SELECT count(*) AS n, sum({LSE}) AS loglik FROM d), "
    "m AS (SELECT component, sum(r) AS rs, sum(r * x) / sum(r) AS mx, sum(r * y) / sum(r) AS my FROM l GROUP BY component), "
    "v AS (SELECT component, sum(r * (x - mx) * (x - mx)) / sum(r) AS vx, sum(r * (y - my) * (y - my)) / sum(r) AS vy FROM l JOIN m USING (component) GROUP BY component) "
    f"SELECT component, {rnd_sql('rs / n')} AS weight, {rnd_sql('mx')} AS mean_x, {rnd_sql('my')} AS mean_y, {rnd_sql('vx')} AS var_x, "
    f"{rnd_sql('vy')} AS var_y, {rnd_sql('loglik', 4)} AS loglik FROM m JOIN v USING (component), n"
)
def gmm_em_step(spark: SparkSession, sf: str) -> DataFrame:
    m = gm.em_step(_pairs(spark, sf), MIX, np.array([25.0, 50.0]))
    rows = [(c, float(m.weights[c]), *map(float, m.means[c]), *map(float, m.covs[c]), m.loglik) for c in range(3)]
    df = spark.createDataFrame(rows, "component int, weight double, mean_x double, mean_y double, var_x double, var_y double, loglik double")
    return df.select("component", *[rnd(c).alias(c) for c in df.columns[1:6]], rnd("loglik", 4).alias("loglik"))


COVARIANCES = (30.0, -40.0, 60.0)
FULL = gm.Mixture(np.array(WEIGHTS), np.array(MEANS), np.array([[[vx, c], [c, vy]] for (vx, vy), c in zip(VARS, COVARIANCES)]))


def _full_density(c: int) -> str:
    (mx, my), (vx, vy), vxy = MEANS[c], VARS[c], COVARIANCES[c]
    det = vx * vy - vxy * vxy
    return (
        f"ln({WEIGHTS[c]}) - 0.5 * (2 * ln(2 * pi()) + ln({det}::DOUBLE) + ({vy} * (l_quantity - {mx}) * (l_quantity - {mx}) "
        f"- 2 * {vxy} * (l_quantity - {mx}) * (l_extendedprice / 1000.0 - {my}) + {vx} * (l_extendedprice / 1000.0 - {my}) * (l_extendedprice / 1000.0 - {my})) / {det}::DOUBLE)"
    )


@catalog.query(
    "WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000.0 AS y, " + ", ".join(f"{_full_density(c)} AS d{c}" for c in range(3)) + " FROM lineitem), "
    f"l AS (SELECT x, y, unnest([0, 1, 2])::INT AS component, unnest([exp(d0 - ({LSE})), exp(d1 - ({LSE})), exp(d2 - ({LSE}))]) AS r FROM d), "
    f"n AS (SELECT count(*) AS n, sum({LSE}) AS loglik FROM d), m AS (SELECT component, sum(r) AS rs, sum(r * x) / sum(r) AS mx, sum(r * y) / sum(r) AS my FROM l GROUP BY component), "
    "v AS (SELECT component, sum(r * (x - mx) * (x - mx)) / sum(r) AS vx, sum(r * (y - my) * (y - my)) / sum(r) AS vy, sum(r * (x - mx) * (y - my)) / sum(r) AS vxy FROM l JOIN m USING (component) GROUP BY component) "
    f"SELECT component, {rnd_sql('rs / n')} AS weight, {rnd_sql('mx')} AS mean_x, {rnd_sql('my')} AS mean_y, {rnd_sql('vx')} AS var_x, {rnd_sql('vy')} AS var_y, "
    f"{rnd_sql('vxy')} AS cov_xy, {rnd_sql('loglik', 4)} AS loglik FROM m JOIN v USING (component), n"
)
def gmm_em_step_full(spark: SparkSession, sf: str) -> DataFrame:
    m = gm.em_step(_pairs(spark, sf), FULL, np.array([25.0, 50.0]))
    rows = [(c, *map(float, (m.weights[c], *m.means[c], m.covs[c][0, 0], m.covs[c][1, 1], m.covs[c][0, 1])), m.loglik) for c in range(3)]
    df = spark.createDataFrame(rows, "component int, weight double, mean_x double, mean_y double, var_x double, var_y double, cov_xy double, loglik double")
    return df.select("component", *[rnd(c).alias(c) for c in df.columns[1:7]], rnd("loglik", 4).alias("loglik"))


@catalog.query(
    f"SELECT label AS component, {rnd_sql('count(*) / sum(count(*)) OVER ()')} AS weight FROM embeddings GROUP BY label"
)
def gmm_weights_norm(spark: SparkSession, sf: str) -> DataFrame:
    """User weights (here the label counts of the table) normalised to sum one."""
    counts = embeddings(spark, sf).groupBy("label").count().orderBy("label").collect()
    w = gm.normalised_weights([r["count"] for r in counts], len(counts))
    return spark.createDataFrame([(r["label"], float(v)) for r, v in zip(counts, w)], "component int, weight double").withColumn("weight", rnd("weight"))


def _gmm_summary(spark: SparkSession, m: gm.Mixture) -> DataFrame:
    rows = [(c, float(m.weights[c]), float(m.means[c][0]), float(m.means[c][1]), m.loglik) for c in range(len(m.weights))]
    return spark.createDataFrame(rows, "component int, weight double, mean_x double, mean_y double, loglik double")


def _keyed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("row_id"), F.array(F.col("o_totalprice") / 1000.0, F.col("o_custkey").cast("double")).alias("features"))


@catalog.query()
def gmm_fit_diagonal(spark: SparkSession, sf: str) -> DataFrame:
    return _gmm_summary(spark, gm.fit_mixture(_keyed_pairs(spark, sf), 3, max_iterations=5, kmeans_max_iterations=5))


@catalog.query()
def gmm_fit_full(spark: SparkSession, sf: str) -> DataFrame:
    """Full covariances, two trials from refined starts, noise on the points; ten steps of either trial."""
    m = gm.fit_mixture(_keyed_pairs(spark, sf), 3, diagonal_covariance=False, trials=2, noise=0.01, refined_start=True, max_iterations=10, kmeans_max_iterations=10)
    return _gmm_summary(spark, m)


@catalog.query()
def gmm_generate_moments(spark: SparkSession, sf: str) -> DataFrame:
    """As many draws as there are orders, from a mixture fitted to them."""
    pairs = _keyed_pairs(spark, sf)
    m = gm.fit_mixture(pairs, 2, max_iterations=3, kmeans_max_iterations=3)
    drawn = gm.generate(spark, m, pairs.count(), seed=3)
    return drawn.groupBy("component").agg(
        F.count("*").alias("n"), F.avg(F.get("features", F.lit(0))).alias("mean_x"), F.stddev_pop(F.get("features", F.lit(0))).alias("std_x")
    )


def _drawn_sql(component: str) -> str:
    u = uniform_sql(GENERATE_SEED, gm.PICK, "row_id")
    features = ", ".join(
        rnd_sql(f"{[m[j] for m in MEANS]!r}[component + 1] + sqrt({[v[j] for v in VARS]!r}[component + 1]) * {normal_sql(GENERATE_SEED, j, 'row_id')}") + f" AS {name}" for j, name in enumerate("xy")
    )
    return (
        f"WITH r AS (SELECT unnest(range((SELECT count(*) FROM orders))) AS row_id), u AS (SELECT row_id, {u} AS u FROM r), "
        f"c AS (SELECT row_id, ({component})::INT AS component FROM u) SELECT row_id, component, {features} FROM c"
    )


def _picked_sql(weights: np.ndarray) -> str:
    return " + ".join(f"(u >= {float(w)!r})::INT" for w in np.cumsum(weights)[:-1])


GENERATE_SEED = 3
OTHER_WEIGHTS = [1.0, 0.5, 2.0]


def _drawn(spark: SparkSession, sf: str, **options: object) -> DataFrame:
    """A draw for every order from the given mixture."""
    drawn = gm.generate(spark, MIX, table(spark, sf, "orders").count(), seed=GENERATE_SEED, **options)
    return drawn.select("row_id", "component", *[rnd(F.get("features", F.lit(j))).alias(name) for j, name in enumerate("xy")])


@catalog.query(_drawn_sql(_picked_sql(np.array(WEIGHTS))))
def gmm_generate(spark: SparkSession, sf: str) -> DataFrame:
    return _drawn(spark, sf)


@catalog.query(_drawn_sql("1"))
def gmm_generate_component(spark: SparkSession, sf: str) -> DataFrame:
    return _drawn(spark, sf, component=1)


@catalog.query(_drawn_sql(_picked_sql(gm.normalised_weights(OTHER_WEIGHTS, 3))))
def gmm_generate_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return _drawn(spark, sf, weights=OTHER_WEIGHTS)


ROWS, COLS = 3, 4


def _som_sql(radii: list[float]) -> str:
    parts = ["e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)", _start_sql(ROWS * COLS)]
    for i, r in enumerate(radii):
        parts.append(f"b{i} AS (SELECT vec_id, any_value(v) AS v, arg_min(node, (list_distance(v, w), node)) AS bmu FROM e, c{i} GROUP BY vec_id)")
        parts.append(
            f"c{i + 1} AS (SELECT node, list(x ORDER BY j) AS w FROM (SELECT c.node, j, sum(h * x) / sum(h) AS x FROM "
            f"(SELECT bmu, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM b{i}) b JOIN (SELECT p.node, q.node AS bmu, "
            f"exp(-(power(p.node % {COLS} - q.node % {COLS}, 2) + power(p.node // {COLS} - q.node // {COLS}, 2)) / (2 * {r!r} * {r!r})) AS h "
            f"FROM c{i} p, c{i} q) c USING (bmu) GROUP BY c.node, j) GROUP BY node)"
        )
    return "WITH " + ", ".join(parts)


def _map_rows(spark: SparkSession, m: som.Map) -> DataFrame:
    return som.map_table(spark, m).select(
        "node", "x", "y", rnd(F.get("features", F.lit(0))).alias("first"),
        rnd(F.aggregate("features", F.lit(0.0), lambda s, v: s + v)).alias("total"),
    )


MAP_COLUMNS = f" SELECT node, node % {COLS} AS x, node // {COLS} AS y, {rnd_sql('w[1]')} AS first, {rnd_sql('list_sum(w)')} AS total FROM "


@catalog.query(_som_sql([som.radius_at(ROWS, COLS, 0, 0, 1)]) + MAP_COLUMNS + "c1")
def som_batch_epoch(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    return _map_rows(spark, som.train_som(e, ROWS, COLS, initialization="sample", id_col="vec_id", seed=SEED))


@catalog.query(_som_sql([som.radius_at(ROWS, COLS, 0, i, 2) for i in range(2)] + [som.radius_at(ROWS, COLS, 0, 0, 1)]) + MAP_COLUMNS + "c3")
def som_map_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Two epochs, then one more on the kept map."""
    e = embeddings(spark, sf)
    first = som.train_som(e, ROWS, COLS, epochs=2, initialization="sample", id_col="vec_id", seed=SEED)
    return _map_rows(spark, som.train_som(e, start=first, epochs=1))


@catalog.query()
def som_online(spark: SparkSession, sf: str) -> DataFrame:
    m = som.train_som(embeddings(spark, sf), 4, 4, epochs=3, batch_process=False, learning_rate=0.05, initialization="uniform")
    return _map_rows(spark, m)
