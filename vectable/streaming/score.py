"""Scoring a stream batch by batch, so that joins and searches of any strategy can answer it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def score_stream(
    stream: DataFrame, apply: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """Append ``apply(batch)`` for every arriving batch below ``path``, exactly once.

    A batch overwrites its own folder, so a replay after a failure changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        apply(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Everything scored so far."""
    return spark.read.parquet(path).drop("batch")
