"""Streams: appending, learning, scoring, and replays."""

import numpy as np
import pytest
from helpers import blobs, points
from pyspark.sql import functions as F

from vectable.operators import clustering as cl, mixture as gm, scaling, trees as tr
from vectable.plans import streams
from vectable.streaming.append import append_stream, read_appended
from vectable.streaming.learn import current_model, learn_stream, update_hoeffding, update_kmeans
from vectable.streaming.score import score_stream


def stream_of(spark, folder, frames):
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)


def finish(q):
    q.awaitTermination()
    assert q.exception() is None


def test_append_numbers_rows_across_batches(spark, tmp_path):
    parts = [points(spark, np.full((n, 1), float(n)), partitions=1) for n in (3, 4, 5)]
    calls = []
    stream = stream_of(spark, str(tmp_path / "in"), parts)
    finish(append_stream(stream, str(tmp_path / "out"), str(tmp_path / "log"), on_change=lambda b, i: calls.append(b.count())))
    got = read_appended(spark, str(tmp_path / "out"))
    assert sorted(r["row_id"] for r in got.collect()) == list(range(12))
    assert sorted(calls) == [3, 4, 5]
    # Nothing new: the stream resumes and emits nothing.
    finish(append_stream(stream, str(tmp_path / "out"), str(tmp_path / "log"), on_change=lambda b, i: calls.append(-1)))
    assert -1 not in calls and read_appended(spark, str(tmp_path / "out")).count() == 12


def test_append_starts_over_on_another_schema(spark, tmp_path):
    a = points(spark, np.zeros((3, 1)), partitions=1)
    b = points(spark, np.zeros((2, 1)), partitions=1).withColumn("extra", F.lit(1))
    finish(append_stream(stream_of(spark, str(tmp_path / "a"), [a]), str(tmp_path / "out"), str(tmp_path / "la")))
    finish(append_stream(stream_of(spark, str(tmp_path / "b"), [b]), str(tmp_path / "out"), str(tmp_path / "lb")))
    got = read_appended(spark, str(tmp_path / "out"))
    assert got.count() == 2 and "extra" in got.columns
    with pytest.raises(ValueError):
        read_appended(spark, str(tmp_path / "nothing"))


def test_replayed_batches_count_once(spark, tmp_path):
    x, y = blobs(np.random.default_rng(1), 50)
    df = points(spark, x, partitions=1, label=y).drop("row_id")
    parts = [df.filter(F.col("label") == c) for c in range(3)]
    start = tr.new_hoeffding(3, 2, tr.HoeffdingParams(observations_before_binning=10, confidence=1 - 1e-12, max_samples=0))
    stream = stream_of(spark, str(tmp_path / "in"), parts)
    finish(learn_stream(stream, start, update_hoeffding, str(tmp_path / "m"), str(tmp_path / "log")))
    tree = current_model(spark, str(tmp_path / "m"))
    # The same input under a fresh log replays batch numbers that are already committed.
    finish(learn_stream(stream, start, update_hoeffding, str(tmp_path / "m"), str(tmp_path / "log2")))
    again = current_model(spark, str(tmp_path / "m"))
    assert sum(sum(n.counts) for n in again.nodes if not n.children) == sum(sum(n.counts) for n in tree.nodes if not n.children)


def test_warm_kmeans_and_streaming_transforms(spark, tmp_path):
    x, y = blobs(np.random.default_rng(2), 40)
    df = points(spark, x, partitions=1, label=y)
    start = cl.KMeansModel(np.array([[1.0, 1.0], [7.0, 1.0], [1.0, 7.0]]), np.zeros(3), 0, False)
    stream = stream_of(spark, str(tmp_path / "in"), [df.filter("row_id % 2 = 0"), df.filter("row_id % 2 = 1")])
    finish(learn_stream(stream, start, update_kmeans, str(tmp_path / "m"), str(tmp_path / "log")))
    m = current_model(spark, str(tmp_path / "m"))
    scaler, mix = scaling.fit_scaler(df, "zca_whitening"), gm.fit_mixture(df, 2, max_iterations=2)

    def apply(q):
        return gm.score(scaling.scale(cl.assign(q, m.centroids), scaler, output_col="scaled"), mix)

    finish(score_stream(stream, apply, str(tmp_path / "out"), str(tmp_path / "log2")))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 120 and out.groupBy("label").agg(F.count_distinct("cluster").alias("n")).filter("n > 1").count() == 0


def test_files_of_a_stream_do_not_grow(spark, tmp_path, monkeypatch):
    """A larger table comes in more files, in as many micro-batches."""
    monkeypatch.setattr(streams, "FILE_ROWS", 10)
    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: str(tmp_path / name))
    seen = []
    query = streams.as_stream(spark.range(100)).writeStream.foreachBatch(lambda batch, i: seen.append(batch.count())).option("checkpointLocation", str(tmp_path / "log"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and sum(seen) == 100
    assert len(list((tmp_path / "stream-input").glob("*.parquet"))) == 12
