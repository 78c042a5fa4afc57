"""Covariance, regression, principal components, factorisation, independent components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.hashing import normal_sql
from vectable.operators import independent as ica, linear as li, moments as mo, reduction as rd
from vectable.plans.common import LINEITEM_FEATURES, LINEITEM_KEY, Catalog, embeddings, rnd, rnd_sql, table

catalog = Catalog()
KEY = ", ".join(LINEITEM_KEY)
SCALED = [f"{c} / 1000.0" if c == "l_extendedprice" else c for c in LINEITEM_FEATURES]


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """Four line item columns, the price in thousands."""
    df = table(spark, sf, "lineitem")
    return df.select(*LINEITEM_KEY, F.array(*[F.expr(c) for c in SCALED]).alias("features"))


def _pair_sql(form: str, digits: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {i}::INT AS i, {j}::INT AS j, {rnd_sql(form.format(x=x, y=y), digits)} AS value FROM lineitem"
        for i, x in enumerate(SCALED)
        for j, y in enumerate(SCALED)
    )


@catalog.query(_pair_sql("avg(({x}) * ({y}))", 6))
def gram_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of products, per row."""
    n, g = mo.gram(_features(spark, sf))
    return mo.matrix_table(spark, g / n).withColumn("value", rnd("value"))


@catalog.query(_pair_sql("covar_samp({x}, {y})", 6))
def covariance(spark: SparkSession, sf: str) -> DataFrame:
    _, c = mo.covariance(_features(spark, sf))
    return mo.matrix_table(spark, c).withColumn("value", rnd("value"))


def _priced(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    return df.select(*LINEITEM_KEY, F.array("l_quantity").alias("features"), (F.col("l_extendedprice") / 1000.0).alias("target"))


PRICE = "l_extendedprice / 1000.0"
FIT = f"WITH f AS (SELECT regr_slope({PRICE}, l_quantity) AS b, regr_intercept({PRICE}, l_quantity) AS a FROM lineitem) "


@catalog.query(FIT + f"SELECT 0::INT AS position, {rnd_sql('a')} AS value FROM f UNION ALL SELECT 1::INT, {rnd_sql('b')} FROM f")
def ols_1d(spark: SparkSession, sf: str) -> DataFrame:
    return li.parameters(spark, li.fit_linear(_priced(spark, sf))).withColumn("value", rnd("value"))


RIDGE = (
    f"WITH m AS (SELECT avg({PRICE}) AS my, avg(l_quantity) AS mx FROM lineitem), s AS (SELECT sum((l_quantity - mx) * ({PRICE} - my)) AS sxy, "
    "sum((l_quantity - mx) * (l_quantity - mx)) AS sxx FROM lineitem, m), f AS (SELECT sxy / (sxx + 50000.0) AS b, mx, my FROM s, m) "
)


@catalog.query(RIDGE + f"SELECT 0::INT AS position, {rnd_sql('my - b * mx')} AS value FROM f UNION ALL SELECT 1::INT, {rnd_sql('b')} FROM f")
def ridge_1d(spark: SparkSession, sf: str) -> DataFrame:
    return li.parameters(spark, li.fit_linear(_priced(spark, sf), lam=50000.0)).withColumn("value", rnd("value"))


@catalog.query(FIT + f"SELECT {KEY}, {rnd_sql('a + b * l_quantity')} AS prediction FROM lineitem, f")
def ols_predict(spark: SparkSession, sf: str) -> DataFrame:
    df = _priced(spark, sf)
    return li.predict_linear(df, li.fit_linear(df)).select(*LINEITEM_KEY, rnd("prediction").alias("prediction"))


@catalog.query(FIT + f"SELECT {rnd_sql(f'avg(power({PRICE} - a - b * l_quantity, 2))')} AS mse FROM lineitem, f")
def ols_mse(spark: SparkSession, sf: str) -> DataFrame:
    df = _priced(spark, sf)
    scored = li.predict_linear(df, li.fit_linear(df))
    return scored.agg(rnd(F.avg(F.pow(F.col("target") - F.col("prediction"), 2))).alias("mse"))


@catalog.query(
    "WITH c AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice / 1000.0) AS my, var_pop(l_quantity) AS xx, "
    "var_pop(l_discount) AS zz, covar_pop(l_quantity, l_discount) AS xz, covar_pop(l_quantity, l_extendedprice / 1000.0) AS xy, "
    "covar_pop(l_discount, l_extendedprice / 1000.0) AS zy FROM lineitem), f AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, "
    "(zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM c) "
    f"SELECT unnest([0, 1, 2])::INT AS position, {rnd_sql('unnest([my - b1 * mx - b2 * mz, b1, b2])')} AS value FROM f"
)
def ols_2d(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select(F.array("l_quantity", "l_discount").alias("features"), (F.col("l_extendedprice") / 1000.0).alias("target"))
    return li.parameters(spark, li.fit_linear(df)).withColumn("value", rnd("value"))


TOTAL = "SELECT i, var_samp(v) AS var FROM (SELECT generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY i"


@catalog.query(f"SELECT {rnd_sql('sum(var)')} AS total_variance, 1.0::DOUBLE AS retained, true AS orthonormal FROM ({TOTAL})")
def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    """All components keep the whole variance; axes are orthonormal."""
    p = rd.fit_pca(embeddings(spark, sf), 0)
    ok = bool(np.abs(p.vectors.T @ p.vectors - np.eye(len(p.values))).max() < 1e-9)
    row = [(float(p.values.sum()), p.retained, ok)]
    out = spark.createDataFrame(row, "total_variance double, retained double, orthonormal boolean")
    return out.withColumn("total_variance", rnd("total_variance")).withColumn("retained", rnd("retained"))


@catalog.query(
    "WITH c AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice / 1000.0) AS my, var_samp(l_quantity) AS a, "
    "var_samp(l_extendedprice / 1000.0) AS d, covar_samp(l_quantity, l_extendedprice / 1000.0) AS b FROM lineitem), "
    "l AS (SELECT *, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS l1 FROM c), v AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS u, "
    "(l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS w FROM l) "
    f"SELECT {KEY}, {rnd_sql('abs(u * (l_quantity - mx) + w * (l_extendedprice / 1000.0 - my))')} AS score FROM lineitem, v"
)
def pca_scores_abs(spark: SparkSession, sf: str) -> DataFrame:
    """First component of two columns (its sign is free)."""
    df = table(spark, sf, "lineitem").select(*LINEITEM_KEY, F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000.0).alias("features"))
    s = rd.pca_scores(df, rd.fit_pca(df, 1))
    return s.select(*LINEITEM_KEY, rnd(F.abs(F.get("scores", F.lit(0)))).alias("score"))


@catalog.query(
    f"SELECT unnest(['randomized', 'randomized-block-krylov', 'quic']) AS method, true AS close_to_exact, {rnd_sql('sum(var)')} AS total_variance FROM ({TOTAL})"
)
def pca_randomized(spark: SparkSession, sf: str) -> DataFrame:
    """Retained variance of the approximate methods within 5 percent of the exact one."""
    e = embeddings(spark, sf)
    exact = rd.fit_pca(e, 5).retained
    rows = []
    for method in rd.METHODS[1:]:
        p = rd.fit_pca(e, 5, method=method, seed=1)
        rows.append((method, bool(exact * 0.95 <= p.retained <= exact * 1.0000001), p.total_variance))
    df = spark.createDataFrame(rows, "method string, close_to_exact boolean, total_variance double")
    return df.withColumn("total_variance", rnd("total_variance"))


@catalog.query("SELECT unnest([0.3, 0.05])::DOUBLE AS epsilon, true AS bound_holds, true AS smaller_basis")
def pca_cosine_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in eight correlated features: the tree's basis leaves out no more than asked, with fewer directions than features."""
    li = table(spark, sf, "lineitem")
    q, p, d, t = F.col("l_quantity") / 25.0, F.col("l_extendedprice") / 50000.0, F.col("l_discount") * 10.0, F.col("l_tax") * 10.0
    df = li.select(F.array(q, p, q + p, q - p, d, d + q, t, t + p).alias("features"))
    exact = rd.fit_pca(df, 3)
    rows = []
    for epsilon in (0.3, 0.05):
        found = rd.fit_pca(df, 3, method="quic", epsilon=epsilon, seed=1)
        rows.append((epsilon, bool(exact.retained - epsilon <= found.retained <= exact.retained + 1e-9), found.basis < 8))
    return spark.createDataFrame(rows, "epsilon double, bound_holds boolean, smaller_basis boolean")


@catalog.query(f"SELECT {rnd_sql('count(*)::DOUBLE')} AS total_variance FROM ({TOTAL})")
def pca_scaled(spark: SparkSession, sf: str) -> DataFrame:
    p = rd.fit_pca(embeddings(spark, sf), 0, scale=True)
    return spark.createDataFrame([(float(p.values.sum()),)], "total_variance double").withColumn("total_variance", rnd("total_variance"))


@catalog.query("SELECT count(*) AS n, true AS non_negative, true AS residue_falls FROM lineitem")
def nmf_residue(spark: SparkSession, sf: str) -> DataFrame:
    """W and H stay non-negative, and more passes lower the residue."""
    df = _features(spark, sf)
    short, longer = rd.fit_nmf(df, 2, max_iterations=1), rd.fit_nmf(df, 2, max_iterations=10)
    w = rd.nmf_rows(df, longer)
    falls = bool(longer.residue < short.residue and (longer.h >= 0).all())
    return w.agg(F.count("*").alias("n"), F.min(F.array_min("w") >= 0).alias("non_negative")).withColumn("residue_falls", F.lit(falls))


# floor(sqrt(n)) spacings of the sorted values.
ENTROPY = (
    "WITH r AS (SELECT o_orderstatus AS g, o_totalprice AS z, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS r, "
    "count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) SELECT a.g, any_value(a.n) AS n, "
    + rnd_sql("sum(ln(greatest(b.z - a.z, 2.2250738585072014e-308)))", 4)
    + " AS entropy FROM r a JOIN r b ON a.g = b.g AND b.r = a.r + floor(sqrt(a.n))::BIGINT GROUP BY a.g"
)


@catalog.query(ENTROPY)
def vasicek_entropy(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("g"), F.col("o_totalprice").alias("z"))
    return ica.spacing_entropy(df, "z", ["o_orderkey"], "g").withColumn("entropy", rnd("entropy", 4))


def _order_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as (price in hundred thousands, customer in thousands)."""
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("row_id"), F.array(F.col("o_totalprice") / 1e5, F.col("o_custkey") / 1e3).alias("features"))


TURNS, NOISE, NOISE_SEED = 8, 0.1, 4


def _noisy_sql(value: str, side: int) -> str:
    return f"({value}) + {NOISE!r} * {normal_sql(NOISE_SEED, side, 'id', 'rep')}"


@catalog.query(
    "WITH o AS (SELECT o_orderkey AS id, o_totalprice / 1e5 AS a, o_custkey / 1e3 AS b, unnest(range(2)) AS rep FROM orders), "
    f"p AS (SELECT {_noisy_sql('a', 0)} AS a, {_noisy_sql('b', 1)} AS b FROM o), t AS (SELECT a, b, unnest(range({TURNS})) AS turn FROM p), "
    f"r AS (SELECT turn, cos(turn * pi() / 2 / {TURNS}) * a - sin(turn * pi() / 2 / {TURNS}) * b AS x, sin(turn * pi() / 2 / {TURNS}) * a + cos(turn * pi() / 2 / {TURNS}) * b AS y FROM t), "
    "z AS (SELECT turn, side, CASE side WHEN 0 THEN x ELSE y END AS z FROM r, (VALUES (0), (1)) AS s(side)), "
    "k AS (SELECT turn, side, z, row_number() OVER (PARTITION BY turn, side ORDER BY z) AS k, count(*) OVER (PARTITION BY turn, side) AS n FROM z) "
    f"SELECT i.turn, {rnd_sql('sum(ln(greatest(j.z - i.z, 2.2250738585072014e-308)))', 4)} AS entropy FROM k i JOIN k j ON i.turn = j.turn AND i.side = j.side AND j.k = i.k + floor(sqrt(i.n))::BIGINT GROUP BY i.turn"
)
def radical_angle_entropy(spark: SparkSession, sf: str) -> DataFrame:
    """The score of given angles with two noisy replicas of every order, by the strategy for large tables."""
    thetas = [k * np.pi / 2.0 / TURNS for k in range(TURNS)]
    scores = ica.angle_entropies(_order_pairs(spark, sf), np.eye(2), thetas, std_dev=NOISE, replicates=2, seed=NOISE_SEED, local_values=0)
    return spark.createDataFrame(list(enumerate(map(float, scores))), "turn bigint, entropy double").withColumn("entropy", rnd("entropy", 4))


@catalog.query()
def radical_unmix(spark: SparkSession, sf: str) -> DataFrame:
    """Two mixed order columns, with the operator's defaults: 30 replicas, 150 angles."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.array(F.col("o_totalprice") / 1e5 + F.col("o_custkey") / 1e3, F.col("o_totalprice") / 1e5 - F.col("o_custkey") / 2e3).alias("features"),
    )
    m = ica.fit_unmixing(o)
    rows = [(i, j, float(m.w[i, j]), m.objective) for i in range(2) for j in range(2)]
    return spark.createDataFrame(rows, "i int, j int, w double, objective double")
