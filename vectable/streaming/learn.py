"""Models that keep learning: one model version per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vectable.operators.clustering import KMeansModel, lloyd
from vectable.operators.som import Map, online_step
from vectable.operators.trees import HoeffdingTree, grow, observe
from vectable.session import reused
from vectable.sources.models import load_model, save_model
from vectable.streaming.state import commit, last_batch

Update = Callable[[DataFrame, object], object]


def current_model(spark: SparkSession, path: str, start: object = None) -> object:
    """The newest committed version below ``path``."""
    last = last_batch(spark, path)
    return start if last is None else load_model(spark, f"{path}/version={last}")


def learn_stream(stream: DataFrame, start: object, update: Update, path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Fold every micro-batch into the model with ``update(batch, model)``.

    Version n is written before it is committed; a replayed batch that is already
    committed is skipped, so every row counts once.
    """
    spark = stream.sparkSession
    # Read once per run; after that this run is the only writer.
    last = last_batch(spark, path)
    state = {"last": last, "model": start if last is None else load_model(spark, f"{path}/version={last}")}

    def fold(batch: DataFrame, batch_id: int) -> None:
        if state["last"] is not None and batch_id <= state["last"]:
            return
        model = state["model"] if batch.isEmpty() else update(batch, state["model"])
        save_model(spark, model, f"{path}/version={batch_id}")
        commit(spark, path, 0, batch_id, 0, 0)
        state.update(last=batch_id, model=model)

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def update_hoeffding(batch: DataFrame, tree: HoeffdingTree) -> HoeffdingTree:
    """Count the batch, then check for splits (columns label, features)."""
    return grow(observe(batch, tree))[0]


def count_only(batch: DataFrame, tree: HoeffdingTree) -> HoeffdingTree:
    """Count the batch without growing the tree."""
    return observe(batch, tree)


def update_kmeans(batch: DataFrame, model: KMeansModel) -> KMeansModel:
    """Cluster each batch starting from the centroids of the one before."""
    with reused(batch, "features") as kept:
        return lloyd(kept, model.centroids, max_iterations=10, empty="allow")


def som_updater(radius: float, rate: float) -> Update:
    """Online map training with a fixed radius and rate."""

    def update(batch: DataFrame, model: Map) -> Map:
        moved = online_step(batch, model, radius, rate)
        return replace(model, nodes=moved.nodes)

    return update
