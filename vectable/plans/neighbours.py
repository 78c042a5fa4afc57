"""Neighbour joins on embeddings, each row of the table against the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectable.operators import layout, neighbors as nb, order, projections, radius, scaling
from vectable.functions import exprs
from vectable.functions.blocks import to_matrix
from vectable.functions.hashing import row_hash_sql
from vectable.operators.joins import join_unique
from vectable.session import cut_lineage
from vectable.plans.common import LINEITEM_KEY, Catalog, embeddings, lineitem, rnd, rnd_sql, table

catalog = Catalog()

PAIRS = (
    "p AS (SELECT a.vec_id AS query_id, b.vec_id AS ref_id, a.label AS q_label, b.label AS r_label, "
    "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist FROM {src} a, {src} b)"
)


def _top(direction: str, k: int, src: str = "embeddings", where: str = "") -> str:
    return (
        "WITH " + PAIRS.format(src=src) + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist "
        f"{direction}, ref_id)::INT AS rank FROM p {where}) SELECT query_id, rank, ref_id, {rnd_sql('dist')} AS dist FROM r WHERE rank <= {k}"
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("dist", rnd("dist"))


def _self_join(spark: SparkSession, sf: str, k: int, **options: object) -> DataFrame:
    e = embeddings(spark, sf)
    return nb.neighbour_join(e, e, k, query_id="vec_id", ref_id="vec_id", **options)


@catalog.query(_top("ASC", 5))
def knn_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_self_join(spark, sf, 5))


@catalog.query(_top("ASC", 5))
def knn_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows by the strategy for large reference sets."""
    return _rounded(_self_join(spark, sf, 5, strategy="blocks", n_pivots=6, block_rows=256))


@catalog.query(_top("DESC", 3))
def kfn_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_self_join(spark, sf, 3, farthest=True))


@catalog.query(_top("DESC", 3))
def kfn_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_self_join(spark, sf, 3, farthest=True, strategy="blocks", n_pivots=6, block_rows=256))


SCALED = (
    "m AS (SELECT i, avg(v) AS mu, stddev_pop(v) AS sd FROM (SELECT generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v "
    "FROM embeddings) GROUP BY i), s AS (SELECT vec_id, any_value(label) AS label, list((v - mu) / sd ORDER BY i) AS embedding FROM "
    "(SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) JOIN m USING (i) GROUP BY vec_id)"
)


@catalog.query("WITH " + SCALED + ", " + _top("ASC", 5, "s")[len("WITH "):])
def knn_scaled(spark: SparkSession, sf: str) -> DataFrame:
    """Autoscale: the scaler is fitted on the reference set and applied to both sides."""
    e = embeddings(spark, sf)
    scaler, ref = scaling.fit_scale(e, "standard")
    return _rounded(nb.knn(scaling.scale(e, scaler), ref, 5, query_id="vec_id", ref_id="vec_id"))


def classify(spark: SparkSession, sf: str, k: int = 5) -> DataFrame:
    """Leave-one-out majority label of the k nearest scaled vectors."""
    e = embeddings(spark, sf)
    _, scaled = scaling.fit_scale(e, "standard")
    hits = nb.knn(scaled, scaled, k, query_id="vec_id", ref_id="vec_id", exclude_self=True)
    labels = e.select(F.col("vec_id").alias("ref_id"), F.col("label").alias("r_label"))
    votes = join_unique(hits, labels, "ref_id").groupBy("query_id", "r_label").agg(F.count("*").alias("votes"))
    best = votes.groupBy("query_id").agg(F.min_by("r_label", F.struct(-F.col("votes"), F.col("r_label"))).alias("predicted"))
    truth = e.select(F.col("vec_id").alias("query_id"), "label")
    return best.join(truth, "query_id").select("query_id", "label", "predicted", (F.col("label") == F.col("predicted")).alias("correct"))


CLASSIFY = (
    "WITH " + SCALED + ", " + PAIRS.format(src="s") + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, ref_id) AS rk "
    "FROM p WHERE query_id <> ref_id), v AS (SELECT query_id, q_label, r_label, count(*) AS votes FROM r WHERE rk <= 5 GROUP BY ALL), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, r_label) AS rk FROM v) "
)


@catalog.query(CLASSIFY + "SELECT query_id, q_label AS label, r_label AS predicted, q_label = r_label AS correct FROM b WHERE rk = 1")
def knn_classify(spark: SparkSession, sf: str) -> DataFrame:
    return classify(spark, sf)


@catalog.query(
    CLASSIFY + f"SELECT count(*) AS n, {rnd_sql('avg((q_label = r_label)::INT::DOUBLE)')} AS accuracy FROM b WHERE rk = 1"
)
def knn_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return classify(spark, sf).agg(F.count("*").alias("n"), rnd(F.avg(F.col("correct").cast("double"))).alias("accuracy"))


@catalog.query(
    "WITH t AS (" + _top("ASC", 3) + ") SELECT query_id, rank, ref_id % 25 AS x, ref_id // 25 AS y, dist FROM t"
)
def knn_coords(spark: SparkSession, sf: str) -> DataFrame:
    """A reference set addressed as a grid answers with coordinates."""
    hits = _rounded(_self_join(spark, sf, 3))
    x, y = layout.coords(F.col("ref_id"), 25)
    return hits.select("query_id", "rank", x.alias("x"), y.alias("y"), "dist")


def _against_exact(spark: SparkSession, sf: str, farthest: bool, error: float, **options: object) -> DataFrame:
    near = _self_join(spark, sf, 5, farthest=farthest, strategy="blocks", n_pivots=6, **options)
    exact = _self_join(spark, sf, 5, farthest=farthest).select("query_id", "rank", F.col("dist").alias("true_dist"))
    limit = F.col("true_dist") * (1.0 - error) <= F.col("dist") + 1e-9 if farthest else F.col("dist") <= F.col("true_dist") * (1.0 + error) + 1e-9
    both = near.join(exact, ["query_id", "rank"])
    return both.groupBy("query_id").agg(F.count("*").alias("found"), F.min(limit).alias("within_error"))


APPROX = "SELECT vec_id AS query_id, 5::BIGINT AS found, true AS within_error FROM embeddings"


@catalog.query(APPROX)
def knn_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Relative error epsilon = 0.2 against the exact join."""
    return _against_exact(spark, sf, False, 0.2, epsilon=0.2)


@catalog.query(APPROX)
def kfn_approx(spark: SparkSession, sf: str) -> DataFrame:
    """At least 80 percent of the true farthest distance."""
    return _against_exact(spark, sf, True, 0.2, epsilon=0.2)


@catalog.query()
def knn_greedy_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Share of true neighbours the greedy search returns."""
    e = embeddings(spark, sf)
    got = _self_join(spark, sf, 5, strategy="blocks", n_pivots=6, greedy=True, tau=0.02)
    exact = _self_join(spark, sf, 5)
    hit = got.join(exact, ["query_id", "ref_id"], "left_semi").count()
    return spark.range(1).select(F.lit(hit / (5.0 * e.count())).alias("recall"))


FAR = 0.8


@catalog.query(
    "SELECT a.vec_id AS query_id, " + rnd_sql("max(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]))")
    + " AS farthest, true AS within_share, true AS few_pairs FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 GROUP BY a.vec_id"
)
def kfn_directions_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Far neighbours of every twentieth vector along random directions: at least 80 percent of the farthest distance, from less than a tenth of all pairs."""
    e = embeddings(spark, sf)
    asked = e.filter(F.col("vec_id") % 20 == 0)
    got, share = projections.kfn_directions(asked, e, 1, query_id="vec_id", ref_id="vec_id")
    exact = nb.kfn(asked, e, 1, query_id="vec_id", ref_id="vec_id").select("query_id", F.col("dist").alias("farthest"))
    within = F.col("dist") >= FAR * F.col("farthest")
    return got.join(exact, "query_id").select("query_id", rnd("farthest").alias("farthest"), within.alias("within_share"), F.lit(share < 0.1).alias("few_pairs"))


@catalog.query("SELECT count(*) AS n_queries, 0::BIGINT AS n_better_than_exact, true AS recall_reached, true AS few_pairs FROM lineitem WHERE l_orderkey % 20 = 0")
def knn_lsh_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed search for the five lines like each line of every twentieth order: nine tenths of the true ones from less than a fifth of all pairs."""
    line = F.xxhash64(*LINEITEM_KEY).alias("row_id")
    _, scaled = scaling.fit_scale(lineitem(spark, sf).select(line, "l_orderkey", "features"), "standard")
    asked = scaled.filter(F.col("l_orderkey") % 20 == 0)
    got, share = projections.knn_hashed(asked, scaled, 5, exclude_self=True)
    # Kept, since reach and distances are both read off it.
    exact = cut_lineage(nb.knn(asked, scaled, 5, exclude_self=True))
    # Lines that are equally near may stand for each other.
    last = exact.filter(F.col("rank") == 5).select("query_id", F.col("dist").alias("reach"))
    true_dist = exact.select("query_id", "rank", F.col("dist").alias("true_dist"))
    hits = got.join(last, "query_id").join(true_dist, ["query_id", "rank"])
    return hits.agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.count_if(F.col("dist") < F.col("true_dist") - 1e-9).alias("n_better_than_exact"),
        (F.count_if(F.col("dist") <= F.col("reach") + 1e-9) >= 0.9 * F.count("*")).alias("recall_reached"),
    ).withColumn("few_pairs", F.lit(share < 0.2))


NEAR = 0.05


@catalog.query(
    "WITH e AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings) SELECT a.vec_id, "
    f"count(*) FILTER (WHERE a.vec_id <> b.vec_id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {NEAR}) AS n_near FROM e a, e b GROUP BY a.vec_id"
)
def radius_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """How many others lie near each vector, by its first two components."""
    e = embeddings(spark, sf).select("vec_id", F.slice("features", 1, 2).alias("features"))
    return radius.radius_counts(e, NEAR, id_col="vec_id")


@catalog.query(
    "SELECT c.c_custkey, s.s_suppkey, " + rnd_sql("abs(c.c_acctbal - s.s_acctbal)") + " AS dist FROM customer c, supplier s WHERE abs(c.c_acctbal - s.s_acctbal) <= 100"
)
def radius_join_balances(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers with nearly the same balance."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), F.array("c_acctbal").alias("features"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("row_id"), F.array("s_acctbal").alias("features"))
    found = radius.radius_join(c, s, 100.0)
    return found.select(F.col("query_id").alias("c_custkey"), F.col("ref_id").alias("s_suppkey"), rnd("dist").alias("dist"))


@catalog.query(
    f"WITH c AS (SELECT row_number() OVER (ORDER BY {row_hash_sql('vec_id', 5)}, vec_id) - 1 AS node, embedding AS w FROM embeddings "
    f"QUALIFY node < 16), d AS (SELECT vec_id, node, list_distance(embedding::DOUBLE[], w::DOUBLE[]) AS dist FROM embeddings, c) "
    f"SELECT vec_id, arg_min(node, (dist, node))::INT AS node, {rnd_sql('min(dist) * min(dist)')} AS sq_dist FROM d GROUP BY vec_id"
)
def bmu_assign(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    codebook = to_matrix(order.sample_rows(e, 16, "vec_id", 5).select("features").toArrow()["features"])
    return nb.best_match(e, codebook).select("vec_id", "bmu.node", rnd("bmu.sq_dist").alias("sq_dist"))


@catalog.query(
    "WITH p AS (SELECT c.c_custkey, s.s_suppkey, abs(c.c_acctbal - s.s_acctbal) AS dist FROM customer c, supplier s) "
    "SELECT c_custkey AS query_id, arg_min(s_suppkey, (dist, s_suppkey)) AS ref_id, " + rnd_sql("min(dist)") + " AS dist FROM p GROUP BY c_custkey"
)
def knn_one_feature(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier with the closest balance for each customer."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), F.array("c_acctbal").alias("features"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("row_id"), F.array("s_acctbal").alias("features"))
    return nb.knn(c, s, 1).select("query_id", "ref_id", rnd("dist").alias("dist"))


@catalog.query(
    "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.vec_id, a.v AS a, b.v AS b FROM e a JOIN e b ON b.vec_id = a.vec_id + 1) "
    f"SELECT vec_id, {rnd_sql('list_distance(a, b)')} AS dist, {rnd_sql('list_distance(a, b) * list_distance(a, b)')} AS sq_dist, {rnd_sql('list_inner_product(a, b)')} AS dot, "
    f"{rnd_sql('list_sum(list_transform(range(1, len(a) + 1), lambda i: (a[i] + b[i]) * i))')} AS added, "
    f"{rnd_sql('list_sum(list_transform(range(1, len(a) + 1), lambda i: a[i] * b[i] * i))')} AS multiplied, "
    f"{rnd_sql('list_sum(list_transform(range(1, len(a) + 1), lambda i: a[i] * 2.5 * i))')} AS scaled FROM p"
)
def vector_expressions(spark: SparkSession, sf: str) -> DataFrame:
    """Sums, products, multiples and distances of every vector and the next one, as Column expressions."""
    e = layout.convert(embeddings(spark, sf), "vector", "vector").select("vec_id", F.col("features").alias("a"))
    p = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b")), "vec_id")
    a, b = F.col("a"), F.col("b")

    def weighed(v: Column) -> Column:
        return F.aggregate(F.transform(v, lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x)

    return p.select(
        "vec_id", rnd(exprs.distance(a, b)).alias("dist"), rnd(exprs.sq_distance(a, b)).alias("sq_dist"), rnd(exprs.dot(a, b)).alias("dot"),
        rnd(weighed(exprs.vector_add(a, b))).alias("added"), rnd(weighed(exprs.vector_multiply(a, b))).alias("multiplied"), rnd(weighed(exprs.vector_scale(a, 2.5))).alias("scaled"),
    )
