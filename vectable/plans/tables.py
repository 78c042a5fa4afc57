"""Layouts, casts, coordinates, lookups, splits, appends, label checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.hashing import row_hash_sql
from vectable.operators import append, layout, lookup as lk, split as sp
from vectable.operators.order import sample_rows, sequence_position
from vectable.plans.common import Catalog, embeddings, lineitem, rnd, rnd_sql, table

catalog = Catalog()
DIM = 64
KEY_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@catalog.query("SELECT p_partkey AS row_id, 2::BIGINT AS dim, p_size::DOUBLE AS f_first, p_retailprice AS f_last FROM part")
def layout_vector(spark: SparkSession, sf: str) -> DataFrame:
    v = layout.convert(table(spark, sf, "part"), "wide", "vector", feature_cols=["p_size", "p_retailprice"], id_col="p_partkey")
    return v.select(
        F.col("p_partkey").alias("row_id"),
        F.size("features").cast("bigint").alias("dim"),
        F.get("features", F.lit(0)).alias("f_first"),
        F.element_at("features", -1).alias("f_last"),
    )


@catalog.query(
    "SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS feature_idx, unnest(embedding)::DOUBLE AS value FROM embeddings"
)
def layout_long(spark: SparkSession, sf: str) -> DataFrame:
    return layout.convert(embeddings(spark, sf), "vector", "long", id_col="vec_id")


@catalog.query(
    "SELECT c_custkey AS row_id, unnest([0, 1])::INT AS feature_idx, unnest([c_nationkey::DOUBLE, c_acctbal]) AS value FROM customer"
)
def layout_wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    df = layout.convert(table(spark, sf, "customer"), "wide", "long", feature_cols=["c_nationkey", "c_acctbal"], id_col="c_custkey")
    return df.withColumnRenamed("c_custkey", "row_id")


@catalog.query("SELECT vec_id, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS f{i}" for i in range(DIM)) + " FROM embeddings")
def layout_wide(spark: SparkSession, sf: str) -> DataFrame:
    return layout.convert(embeddings(spark, sf), "vector", "wide", dim=DIM, id_col="vec_id")


@catalog.query("SELECT vec_id, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS f{i}" for i in range(DIM)) + " FROM embeddings")
def layout_long_to_wide(spark: SparkSession, sf: str) -> DataFrame:
    long = layout.convert(embeddings(spark, sf), "vector", "long", id_col="vec_id")
    return layout.convert(long, "long", "wide", dim=DIM, id_col="vec_id")


@catalog.query(
    "SELECT vec_id, 64::BIGINT AS dim, embedding[1]::DOUBLE AS f_first, embedding[64]::DOUBLE AS f_last, true AS equal_to_input "
    "FROM embeddings"
)
def transpose_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    src = embeddings(spark, sf)
    long = layout.transpose(layout.transpose(layout.vector_to_long(src, "vec_id"), "vec_id"), "vec_id")
    back = layout.long_to_vector(long, "vec_id").withColumnRenamed("features", "back")
    return src.join(back, "vec_id").select(
        "vec_id",
        F.size("back").cast("bigint").alias("dim"),
        F.get("back", F.lit(0)).alias("f_first"),
        F.element_at("back", -1).alias("f_last"),
        (F.col("back") == F.col("features")).alias("equal_to_input"),
    )


@catalog.query(
    "SELECT feature_idx, count(*) AS n_points, "
    + rnd_sql("sum(value)", 6)
    + " AS total FROM (SELECT (generate_subscripts(embedding, 1) - 1)::BIGINT AS feature_idx, unnest(embedding)::DOUBLE AS value FROM embeddings) "
    "GROUP BY feature_idx"
)
def transpose_points(spark: SparkSession, sf: str) -> DataFrame:
    """Transposed view: each feature becomes a point; summed per new point instead of rebuilt as one huge vector."""
    t = layout.transpose(layout.vector_to_long(embeddings(spark, sf), "vec_id"), "vec_id")
    return t.groupBy(F.col("vec_id").alias("feature_idx")).agg(F.count("*").alias("n_points"), rnd(F.sum("value")).alias("total"))


@catalog.query(f"SELECT {KEY_SQL}, trunc(l_extendedprice)::BIGINT AS price_long, trunc(l_quantity)::BIGINT AS quantity_long FROM lineitem")
def cast_long(spark: SparkSession, sf: str) -> DataFrame:
    df = lineitem(spark, sf, ("l_extendedprice", "l_quantity")).withColumn("features", layout.cast_long("features"))
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.get("features", F.lit(0)).alias("price_long"),
        F.get("features", F.lit(1)).alias("quantity_long"),
    )


@catalog.query("SELECT p_partkey, p_partkey % 40 AS x, p_partkey // 40 AS y FROM part")
def coords_from_index(spark: SparkSession, sf: str) -> DataFrame:
    x, y = layout.coords(F.col("p_partkey"), 40)
    return table(spark, sf, "part").select("p_partkey", x.alias("x"), y.alias("y"))


@catalog.query(
    "SELECT p_partkey, least(greatest(p_partkey // 7 - 20, 0), 11) * 30 + least(greatest(p_size::BIGINT - 5, 0), 29) AS idx FROM part"
)
def index_from_coords_clamped(spark: SparkSession, sf: str) -> DataFrame:
    y = F.expr("p_partkey div 7 - 20")
    return table(spark, sf, "part").select("p_partkey", layout.flat_index(F.col("p_size") - 5, y, 30, 12).alias("idx"))


LOOKUP_SQL = (
    "WITH n AS (SELECT count(*) AS n FROM customer), q AS (SELECT o_orderkey, {key} AS k FROM orders, n) "
    "SELECT o_orderkey, c_custkey, c_name, c_acctbal FROM q JOIN customer ON c_custkey = k"
)


def _lookup_result(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "c_custkey", "c_name", "c_acctbal")


@catalog.query(LOOKUP_SQL.format(key="o_custkey"))
def lookup_1d(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return _lookup_result(lk.lookup(q, table(spark, sf, "customer"), index_col="o_custkey", id_col="c_custkey"))


@catalog.query(
    LOOKUP_SQL.format(key="least(greatest(o_custkey * 2 - 500, 0), n - 1)")
)
def lookup_clamped(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") * 2 - 500).alias("idx"))
    return _lookup_result(lk.lookup(q, table(spark, sf, "customer"), id_col="c_custkey"))


@catalog.query(
    LOOKUP_SQL.format(
        key="least(greatest(least(greatest(o_custkey // 10, 0), (n + 24) // 25 - 1) * 25 + least(greatest(o_orderkey % 40 - 5, 0), 24), 0), n - 1)"
    )
)
def lookup_2d(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 40 - 5).alias("x"), F.expr("o_custkey div 10").alias("y"))
    return _lookup_result(lk.lookup_grid(q, table(spark, sf, "customer"), width=25, id_col="c_custkey"))


@catalog.query(
    "WITH n AS (SELECT count(*) AS n FROM embeddings) SELECT c_custkey, vec_id AS row_id, "
    "(generate_subscripts(embedding, 1) - 1)::INT AS feature_idx, unnest(embedding)::DOUBLE AS value "
    "FROM customer JOIN embeddings ON vec_id = least(c_custkey, (SELECT n FROM n) - 1)"
)
def lookup_long_output(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").alias("idx"))
    hit = lk.lookup(q, embeddings(spark, sf).withColumnRenamed("vec_id", "row_id"))
    return hit.select("c_custkey", "row_id", F.posexplode("features").alias("feature_idx", "value"))


def _sides(parts: tuple[DataFrame, DataFrame], *cols: str) -> DataFrame:
    train, test = parts
    return train.select(*cols, F.lit("train").alias("part")).unionByName(test.select(*cols, F.lit("test").alias("part")))


@catalog.query(
    "SELECT vec_id, label, CASE WHEN row_number() OVER (ORDER BY vec_id) > count(*) OVER () - floor(count(*) OVER () * 0.2) "
    "THEN 'test' ELSE 'train' END AS part FROM embeddings"
)
def split_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(sp.split(embeddings(spark, sf), 0.2, shuffle=False, id_col="vec_id"), "vec_id", "label")


@catalog.query(
    f"SELECT o_orderkey, o_totalprice, CASE WHEN row_number() OVER (ORDER BY {row_hash_sql('o_orderkey', 7)}, o_orderkey) "
    "<= floor(count(*) OVER () * 0.3) THEN 'test' ELSE 'train' END AS part FROM orders"
)
def split_hashed(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(sp.split(table(spark, sf, "orders"), 0.3, id_col="o_orderkey", seed=7), "o_orderkey", "o_totalprice")


@catalog.query(
    f"SELECT vec_id, label, CASE WHEN row_number() OVER (ORDER BY {row_hash_sql('vec_id', 1)}, vec_id) "
    "<= floor(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS part FROM embeddings"
)
def split_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    parts = sp.split_with_labels(e.select("vec_id", "features"), e.select("vec_id", "label"), 0.2, id_col="vec_id", seed=1)
    return _sides(parts, "vec_id", "label")


@catalog.query(
    "SELECT o_orderkey AS row_id, o_totalprice AS value FROM orders UNION ALL "
    "SELECT c_custkey + (SELECT max(o_orderkey) + 1 FROM orders), c_acctbal FROM customer"
)
def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("value"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_acctbal").alias("value"))
    return append.append_rows([a, b])


@catalog.query(
    "SELECT o_orderkey AS row_id, unnest([0, 1])::INT AS feature_idx, unnest([o_totalprice, o_custkey::DOUBLE]) AS value FROM orders UNION ALL "
    "SELECT c_custkey + (SELECT max(o_orderkey) + 1 FROM orders), unnest([0, 1])::INT, unnest([c_acctbal, c_nationkey::DOUBLE]) FROM customer"
)
def append_points(spark: SparkSession, sf: str) -> DataFrame:
    a = layout.wide_to_long(table(spark, sf, "orders"), ["o_totalprice", "o_custkey"], "o_orderkey").withColumnRenamed("o_orderkey", "row_id")
    b = layout.wide_to_long(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"], "c_custkey").withColumnRenamed("c_custkey", "row_id")
    return append.append_points_long([a, b])


@catalog.query(
    "SELECT c_custkey AS row_id, c_acctbal AS value FROM customer"
)
def append_reset(spark: SparkSession, sf: str) -> DataFrame:
    """A table with other columns starts the concatenation over."""
    a = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_acctbal").alias("value"))
    return append.append_rows([a, b])


@catalog.query(
    "SELECT (max(quality) + 1)::BIGINT AS n_classes, count(DISTINCT quality) AS n_distinct, "
    "min(quality) = 0 AND count(DISTINCT quality) = max(quality) + 1 AS contiguous FROM labels"
)
def label_contiguity(spark: SparkSession, sf: str) -> DataFrame:
    return layout.label_summary(table(spark, sf, "labels"), "quality")


@catalog.query(
    "SELECT (SELECT count(*) FROM documents d ANTI JOIN labels l USING (doc_id)) AS points_without_label, "
    "(SELECT count(*) FROM labels l ANTI JOIN documents d USING (doc_id)) AS labels_without_point"
)
def label_obs_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return layout.mismatch_counts(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@catalog.query(
    "SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)"
)
def attach_labels(spark: SparkSession, sf: str) -> DataFrame:
    return lk.attach(table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels"), "doc_id")


@catalog.query(
    "SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos "
    "FROM orders"
)
def order_position(spark: SparkSession, sf: str) -> DataFrame:
    """0-based position inside a sequence; the sequence may be of any length."""
    df = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return sequence_position(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@catalog.query(
    f"SELECT vec_id, label FROM embeddings ORDER BY {row_hash_sql('vec_id', 3)}, vec_id LIMIT 25"
)
def sample_points(spark: SparkSession, sf: str) -> DataFrame:
    return sample_rows(embeddings(spark, sf).select("vec_id", "label"), 25, "vec_id", 3)

