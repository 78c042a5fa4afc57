"""A small manifest table that records what a streaming job has committed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "generation bigint, batch bigint, rows bigint, top bigint, schema string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed batch of each generation; a replayed batch counts once."""
    try:
        found = spark.read.schema(SCHEMA).json(f"{path}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)
    return found.groupBy("generation", "batch").agg(*[F.max(c).alias(c) for c in ("rows", "top", "schema")])


def commit(spark: SparkSession, path: str, generation: int, batch: int, rows: int, top: int, schema: str = "") -> None:
    spark.createDataFrame([(generation, batch, rows, top, schema)], SCHEMA).coalesce(1).write.mode("append").json(f"{path}/manifest")


def last_batch(spark: SparkSession, path: str, generation: int | None = None) -> int | None:
    m = read_manifest(spark, path)
    if generation is not None:
        m = m.filter(F.col("generation") == generation)
    return m.agg(F.max("batch")).first()[0]
