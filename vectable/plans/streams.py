"""The operators on streams of the given tables, and model tables written and read back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.operators import clustering as cl, linear as li, lookup as lk, neighbors as nb, scaling, som, trees as tr
from vectable.plans import neighbours, reductions, scalers, supervised, tables
from vectable.plans.common import LINEITEM_FEATURES, LINEITEM_KEY, Catalog, embeddings, lineitem, rnd, table
from vectable.session import scratch_path
from vectable.sources.models import load_model, load_search, load_tree, save_model
from vectable.streaming.append import append_stream, read_appended
from vectable.streaming.learn import count_only, current_model, learn_stream, som_updater, update_hoeffding, update_kmeans
from vectable.streaming.score import read_scores, score_stream

catalog = Catalog()
BATCHES = 3
#: Rows that a file of a stream has at most, about, and so a task that writes it.
FILE_ROWS = 1_000_000


def as_stream(df: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The table as a file stream that is delivered in so many micro-batches; their files do not grow with the table."""
    spark = df.sparkSession
    folder = scratch_path(spark, "stream-input")
    files = max(1, -(-df.count() // (batches * FILE_ROWS)))
    df.repartition(batches * files).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _finish(query: object) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


KEYED = ", ".join(LINEITEM_KEY) + ", " + ", ".join(LINEITEM_FEATURES)


@catalog.query(f"SELECT {KEYED} FROM lineitem")
def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    li_ = lineitem(spark, sf).withColumn("row_id", F.col("l_orderkey"))
    path = scratch_path(spark, "append")
    _finish(append_stream(as_stream(li_), path, scratch_path(spark, "append-log")))
    return read_appended(spark, path).select(*LINEITEM_KEY, *[F.get("features", F.lit(i)).alias(c) for i, c in enumerate(LINEITEM_FEATURES)])


@catalog.query(f"SELECT {KEYED} FROM lineitem")
def stream_changed(spark: SparkSession, sf: str) -> DataFrame:
    """What is handed on when an arriving batch changes the table: every batch with rows, once."""
    path, seen = scratch_path(spark, "append"), scratch_path(spark, "changes")
    stream = as_stream(lineitem(spark, sf).withColumn("row_id", F.col("l_orderkey")))

    def changed(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")

    _finish(append_stream(stream, path, scratch_path(spark, "append-log"), on_change=changed))
    return spark.read.parquet(seen).select(*LINEITEM_KEY, *[F.get("features", F.lit(i)).alias(c) for i, c in enumerate(LINEITEM_FEATURES)])


@catalog.query(supervised.catalog.oracle["hoeffding_leaf_counts"])
def stream_hoeffding_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts folded over micro-batches equal the counts of the whole table."""
    path = scratch_path(spark, "tree")
    stream = as_stream(supervised._flags(spark, sf))
    _finish(learn_stream(stream, supervised._given_tree(), count_only, path, scratch_path(spark, "tree-log")))
    tree = current_model(spark, path)
    rows = [(leaf, int(f), int(b), int(c), int(t[f, b, c])) for leaf, t in tree.histograms.items() for f, b, c in zip(*np.nonzero(t))]
    return spark.createDataFrame(rows, "leaf int, feature_idx int, bin int, class int, n bigint")


@catalog.query(supervised.ACCURATE)
def stream_hoeffding_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """A tree grown on the stream, then asked about the whole table."""
    df = supervised._blobs(spark, sf)
    path = scratch_path(spark, "tree")
    start = tr.new_hoeffding(3, 2, tr.HoeffdingParams(bins=16))
    _finish(learn_stream(as_stream(df), start, update_hoeffding, path, scratch_path(spark, "tree-log")))
    return supervised._above(tr.hoeffding_predict(df, current_model(spark, path)), 0.85)


def _searched(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    e = embeddings(spark, sf)
    path = scratch_path(spark, "scores")

    def search(q: DataFrame) -> DataFrame:
        return nb.knn(q, e, 5, query_id="vec_id", ref_id="vec_id", strategy=strategy)

    _finish(score_stream(as_stream(e), search, path, scratch_path(spark, "scores-log")))
    return read_scores(spark, path).withColumn("dist", rnd("dist"))


@catalog.query(neighbours.catalog.oracle["knn_exact"])
def stream_score_knn(spark: SparkSession, sf: str) -> DataFrame:
    return _searched(spark, sf, "auto")


@catalog.query(neighbours.catalog.oracle["knn_exact"])
def stream_score_knn_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The way of reference sets that are too large to be sent to every task."""
    return _searched(spark, sf, "blocks")


@catalog.query(tables.catalog.oracle["lookup_1d"])
def stream_lookup(spark: SparkSession, sf: str) -> DataFrame:
    data, path = table(spark, sf, "customer"), scratch_path(spark, "lookups")

    def answer(q: DataFrame) -> DataFrame:
        return lk.lookup(q, data, index_col="o_custkey", id_col="c_custkey")

    stream = as_stream(table(spark, sf, "orders").select("o_orderkey", "o_custkey"))
    _finish(score_stream(stream, answer, path, scratch_path(spark, "lookups-log")))
    return read_scores(spark, path).select("o_orderkey", "c_custkey", "c_name", "c_acctbal")


@catalog.query()
def stream_kmeans_warm(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    start = cl.kmeans(e, 5, max_iterations=1, id_col="vec_id")
    path = scratch_path(spark, "kmeans")
    _finish(learn_stream(as_stream(e), start, update_kmeans, path, scratch_path(spark, "kmeans-log")))
    m = current_model(spark, path)
    return cl.assign(e, m.centroids).groupBy("cluster").agg(F.count("*").alias("n"))


@catalog.query()
def stream_som_online(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    path = scratch_path(spark, "som")
    start = som.start_map(e, 3, 3, initialization="sample", id_col="vec_id")
    _finish(learn_stream(as_stream(e), start, som_updater(1.5, 0.05), path, scratch_path(spark, "som-log")))
    return som.map_table(spark, current_model(spark, path)).select("node", "x", "y", F.get("features", F.lit(0)).alias("first"))


# --- model tables -------------------------------------------------------------------------


@catalog.query(scalers.catalog.oracle["scale_standard"])
def scaler_write_read(spark: SparkSession, sf: str) -> DataFrame:
    df = lineitem(spark, sf)
    path = scratch_path(spark, "scaler") + ".json"
    save_model(spark, scaling.fit_scaler(df, "standard"), path)
    return scalers._wide(scaling.scale(df, load_model(spark, path)))


@catalog.query(reductions.catalog.oracle["ols_predict"])
def model_write_read(spark: SparkSession, sf: str) -> DataFrame:
    df = reductions._priced(spark, sf)
    path = scratch_path(spark, "model")
    save_model(spark, li.fit_linear(df), path)
    return li.predict_linear(df, load_model(spark, path)).select(*LINEITEM_KEY, rnd("prediction").alias("prediction"))


def _search_read_back(spark: SparkSession, sf: str, farthest: bool) -> DataFrame:
    e = embeddings(spark, sf).select(F.col("vec_id").alias("row_id"), "features")
    path = scratch_path(spark, "search")
    save_model(spark, nb.NeighbourSearch(e, {"farthest": farthest}), path)
    return load_search(spark, path).search(e, 3 if farthest else 5).withColumn("dist", rnd("dist"))


@catalog.query(neighbours.catalog.oracle["knn_exact"])
def knn_write_read(spark: SparkSession, sf: str) -> DataFrame:
    return _search_read_back(spark, sf, False)


@catalog.query(neighbours.catalog.oracle["kfn_exact"])
def kfn_write_read(spark: SparkSession, sf: str) -> DataFrame:
    return _search_read_back(spark, sf, True)


@catalog.query(supervised.ACCURATE)
def tree_write_read(spark: SparkSession, sf: str) -> DataFrame:
    df = supervised._blobs(spark, sf)
    path = scratch_path(spark, "tree")
    save_model(spark, tr.fit_tree(df, maximum_depth=5), path)
    return supervised._above(tr.tree_predict(df, load_tree(path)), 0.9)


@catalog.query("SELECT vec_id, true AS same FROM embeddings")
def model_formats(spark: SparkSession, sf: str) -> DataFrame:
    """All three formats: centroids read back assign every point alike."""
    e = embeddings(spark, sf)
    m = cl.kmeans(e, 4, max_iterations=2, id_col="vec_id")
    base = scratch_path(spark, "formats")
    read = []
    for ext in (".json", ".xml", ""):
        save_model(spark, m, base + ext)
        read.append(load_model(spark, base + ext))
    out = cl.assign(e, m.centroids)
    for i, r in enumerate(read):
        out = cl.assign(out, r.centroids, output_col=f"c{i}")
    same = (F.col("c0") == F.col("cluster")) & (F.col("c1") == F.col("cluster")) & (F.col("c2") == F.col("cluster"))
    return out.select("vec_id", same.alias("same"))


@catalog.query(
    "WITH s AS (SELECT min(p_size) AS a, max(p_size) AS b, avg(p_size) AS m, min(p_retailprice) AS c, max(p_retailprice) AS d, avg(p_retailprice) AS n FROM part), "
    "u AS (SELECT p_partkey, (p_size - m) / (b - a) AS x, (p_retailprice - n) / (d - c) AS y FROM part, s), "
    "k AS (SELECT unnest([0, 1])::INT AS cluster, unnest([-0.25::DOUBLE, 0.25]) AS kx, unnest([-0.25::DOUBLE, 0.25]) AS ky) "
    "SELECT p_partkey, arg_min(cluster, ((x - kx) * (x - kx) + (y - ky) * (y - ky), cluster)) AS cluster FROM u, k GROUP BY p_partkey"
)
def autoscale_assign(spark: SparkSession, sf: str) -> DataFrame:
    """A model behind an autoscaler, saved and read back as one: queries go through the training scaler."""
    parts = table(spark, sf, "part").select("p_partkey", F.array(F.col("p_size").cast("double"), F.col("p_retailprice")).alias("features"))
    given = np.array([[-0.25, -0.25], [0.25, 0.25]])
    fitted = scaling.fit_autoscaled(parts, lambda d: cl.KMeansModel(given, np.zeros(2), 0, True))
    path = scratch_path(spark, "autoscaled")
    save_model(spark, fitted, path)
    out = scaling.apply_autoscaled(parts, load_model(spark, path), lambda d, m: cl.assign(d, m.centroids))
    return out.select("p_partkey", "cluster")
