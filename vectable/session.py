"""Where intermediate tables live, and how iterative jobs cut their lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a fresh temporary folder; on a cluster a missing
    setting is an error, because executors cannot share a machine-local path.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vectable-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: keeps partitions and their order, survives lost executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def reused(df: DataFrame, *columns: str) -> Iterator[DataFrame]:
    """The named columns, kept for the passes of an iterative job and released afterwards.

    Blocks lost with an executor are recomputed from the source.  Inputs that
    arrive in fewer partitions than there are cores (small files) are spread
    out; large inputs keep the partitions of their scan.
    """
    kept = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    cores = df.sparkSession.sparkContext.defaultParallelism
    spread = None
    try:
        if kept.rdd.getNumPartitions() < cores:
            spread = kept.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
        yield kept if spread is None else spread
    finally:
        if spread is not None:
            spread.unpersist()
        kept.unpersist()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the tasks of a running session (once per session)."""
    sc = spark.sparkContext
    if getattr(sc, "_vectable_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="vectable-"), "vectable.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(here):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(target)
    sc._vectable_shipped = True
