"""Numeric text files: tables of the test data written as text and loaded back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.plans.common import Catalog, table
from vectable.session import scratch_path
from vectable.sources.text import load, load_labels

catalog = Catalog()


def _written(spark: SparkSession, sf: str, separator: str, header: list[str] | None = None) -> str:
    """Parts in key order as headerless text: key, size, price."""
    folder = scratch_path(spark, "text")
    if header:
        spark.createDataFrame([(h,) for h in header], "value string").coalesce(1).write.text(folder)
    lines = table(spark, sf, "part").orderBy("p_partkey").select(
        F.concat_ws(separator, F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")).alias("value")
    )
    lines.write.mode("append").text(folder)
    return folder


PART = (
    "SELECT p_partkey::DOUBLE AS key, p_size::DOUBLE AS size, p_retailprice AS price FROM part"
)


def _loader(kind: str, separator: str, header: list[str] | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        points = load(spark, _written(spark, sf, separator, header), kind=kind, layout="wide", dim=3)
        return points.select(F.col("f0").alias("key"), F.col("f1").alias("size"), F.col("f2").alias("price"))

    return run


ARFF_HEADER = ["% parts", "@relation part", "@attribute key numeric", "@attribute size numeric", "@attribute price numeric", "@data"]
for _name, _kind, _separator, _header in (
    ("load_csv", "csv", ",", None),
    ("load_tsv", "tsv", "\t", None),
    ("load_txt", "txt", "  ", None),
    ("load_arff", "arff", ",", ARFF_HEADER),
):
    catalog.queries[_name] = _loader(_kind, _separator, _header)
    catalog.oracle[_name] = PART


@catalog.query(
    "SELECT unnest([0, 1, 2])::BIGINT AS row_id, row_number() OVER (ORDER BY p_partkey) - 1 AS feature_idx, "
    "unnest([p_partkey::DOUBLE, p_size::DOUBLE, p_retailprice]) AS value FROM part"
)
def load_transposed(spark: SparkSession, sf: str) -> DataFrame:
    """Each file column is a point; kept long, since a point has as many features as the file has lines."""
    return load(spark, _written(spark, sf, ","), kind="csv", transposed=False, layout="long")


@catalog.query(
    "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row_id, p_size::INT AS label, p_retailprice AS price FROM part"
)
def load_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Points and labels from two files, aligned by line."""
    folder = scratch_path(spark, "labels")
    table(spark, sf, "part").orderBy("p_partkey").select(F.col("p_size").cast("string").alias("value")).write.text(folder)
    points = load(spark, _written(spark, sf, ","), kind="csv")
    return points.join(load_labels(spark, folder), "row_id").select("row_id", "label", F.get("features", F.lit(2)).alias("price"))
