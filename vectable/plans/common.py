"""Shared table readers and the registration decorator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

LINEITEM_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINEITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.oracle[fn.__name__] = sql
            return fn

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, features ARRAY<DOUBLE>, label)."""
    df = table(spark, sf_dir, "embeddings")
    return df.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def lineitem(spark: SparkSession, sf_dir: str, features: tuple[str, ...] = LINEITEM_FEATURES, keep: tuple[str, ...] = LINEITEM_KEY) -> DataFrame:
    """Line item columns as feature vectors."""
    df = table(spark, sf_dir, "lineitem")
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in features]).alias("features"))


def rnd(column: Column | str, digits: int = 6) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits)


def rnd_sql(expr: str, digits: int = 6) -> str:
    """DuckDB rounding that never leaves a negative zero."""
    return f"(round({expr}, {digits}) + 0.0)"
