"""Concatenation of arriving micro-batches into one growing feature table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vectable.streaming.state import commit, read_manifest


def _generation(spark: SparkSession, path: str, schema: str) -> int:
    """The running generation, or a new one when the arriving schema differs from its."""
    last = read_manifest(spark, path).orderBy(F.col("generation").desc()).first()
    if last is None:
        return 0
    return last["generation"] if last["schema"] == schema else last["generation"] + 1


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    id_col: str = "row_id",
    on_change: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append every batch below ``path``; a stream with another schema starts the table over.

    Ids of a batch move up by the ids before it as it is written.  Batches overwrite
    their own folder, so a replay after a failure changes nothing.  ``on_change`` is called with each batch that brought rows, never for an empty one.
    """
    spark = stream.sparkSession
    schema = stream.schema.json()
    generation = _generation(spark, path, schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        earlier = read_manifest(spark, path).filter((F.col("generation") == generation) & (F.col("batch") < batch_id))
        offset = earlier.agg(F.max("top")).first()[0]
        folder = f"{path}/generation={generation}/batch={batch_id}"
        moved = batch.withColumn(id_col, F.col(id_col).cast("bigint") + (0 if offset is None else offset + 1))
        moved.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(moved.schema).parquet(folder)
        size = written.agg(F.count("*").alias("n"), F.max(id_col).alias("top")).first()
        commit(spark, path, generation, batch_id, size["n"], offset if size["top"] is None else size["top"], schema)
        if on_change is not None and size["n"]:
            on_change(written, batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The table so far."""
    manifest = read_manifest(spark, path)
    last = manifest.orderBy(F.col("generation").desc()).first()
    if last is None:
        raise ValueError(f"nothing appended below {path!r} yet")
    # Batches come in order; a folder beyond the last committed one is of a batch that will be replayed.
    done = manifest.filter(F.col("generation") == last["generation"]).agg(F.max("batch")).first()[0]
    folder = f"{path}/generation={last['generation']}"
    return spark.read.option("basePath", folder).parquet(folder).filter(F.col("batch") <= done).drop("batch")
