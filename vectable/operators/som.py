"""Self-organising map: batch epochs as one aggregation per epoch, mini-batch updates for streams."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from vectable.functions.blocks import nearest, sum_over_rows, to_matrix
from vectable.operators.order import sample_rows
from vectable.session import reused


@dataclass(frozen=True)
class Map:
    """Codebook of rows x cols nodes; node i sits at (i % cols, i // cols)."""

    rows: int
    cols: int
    nodes: np.ndarray

    def grid_sq(self) -> np.ndarray:
        """Squared grid distance between nodes."""
        i = np.arange(self.rows * self.cols)
        x, y = i % self.cols, i // self.cols
        return ((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2).astype(float)


def start_map(
    df: DataFrame, rows: int = 8, cols: int = 8, *, initialization: str = "uniform", id_col: str = "row_id", seed: int = 0
) -> Map:
    n = rows * cols
    if initialization == "sample":
        drawn = to_matrix(sample_rows(df, n, id_col, seed).select("features").toArrow()["features"])
        return Map(rows, cols, drawn[np.resize(np.arange(len(drawn)), n)])
    dim = len(df.select("features").first()[0])
    rng = np.random.default_rng(seed)
    if initialization == "uniform":
        return Map(rows, cols, rng.random((n, dim)))
    if initialization == "gaussian":
        return Map(rows, cols, rng.standard_normal((n, dim)))
    raise ValueError("initialization is uniform, gaussian or sample")


def radius_at(rows: int, cols: int, neighborhood: int, epoch: int, epochs: int) -> float:
    """Neighbourhood radius: half the map (or less if asked), decaying exponentially to 1."""
    start = max(rows, cols) // 2
    if neighborhood:
        start = min(neighborhood, start)
    start = max(start, 1)
    if start == 1:
        return 1.0
    return start * math.exp(-epoch * math.log(start) / epochs)


def _node_sums(df: DataFrame, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature sums and counts per best-matching node."""

    def step(x: np.ndarray) -> dict[str, np.ndarray]:
        idx, _ = nearest(x, nodes)
        cols = [np.bincount(idx, x[:, j], len(nodes)) for j in range(x.shape[1])]
        return {"s": np.stack(cols, 1), "n": np.bincount(idx, minlength=len(nodes)).astype(float)}

    out = sum_over_rows(df, ["features"], step)
    return out["s"], out["n"]


def batch_epoch(df: DataFrame, current: Map, radius: float) -> Map:
    """Replace every node by the neighbourhood-weighted mean of all points.

    Points are summed per best-matching node first; the node x node weighting then
    works on the small sums only.
    """
    sums, counts = _node_sums(df, current.nodes)
    h = np.exp(-current.grid_sq() / (2.0 * radius * radius))
    weight = h.T @ counts
    moved = np.where(weight[:, None] > 0, (h.T @ sums) / np.maximum(weight, 1e-300)[:, None], current.nodes)
    return replace(current, nodes=moved)


def online_step(df: DataFrame, current: Map, radius: float, rate: float) -> Map:
    """Mini-batch form of the per-point update: each node moves towards the weighted mean of the
    points whose best match lies inside the radius, by 1 - (1 - rate)^weight as that many
    single updates would."""
    sums, counts = _node_sums(df, current.nodes)
    sq = current.grid_sq()
    h = np.where(sq < radius * radius, np.exp(-sq / (2.0 * radius * radius)), 0.0)
    weight = h.T @ counts
    target = (h.T @ sums) / np.maximum(weight, 1e-300)[:, None]
    gain = 1.0 - np.power(1.0 - min(rate, 1.0), weight)
    return replace(current, nodes=current.nodes + gain[:, None] * np.where(weight[:, None] > 0, target - current.nodes, 0.0))


def train_som(
    df: DataFrame,
    rows: int = 8,
    cols: int = 8,
    *,
    epochs: int = 1,
    neighborhood: int = 0,
    initialization: str = "uniform",
    batch_process: bool = True,
    learning_rate: float = 0.01,
    start: Map | None = None,
    id_col: str = "row_id",
    seed: int = 0,
) -> Map:
    """Train a new map, or continue from ``start``."""
    current = start or start_map(df, rows, cols, initialization=initialization, id_col=id_col, seed=seed)
    with reused(df, "features") as kept:
        for e in range(epochs):
            radius = radius_at(current.rows, current.cols, neighborhood, e, epochs)
            if batch_process:
                current = batch_epoch(kept, current, radius)
            else:
                current = online_step(kept, current, radius, learning_rate * math.exp(-e / epochs))
    return current


def map_table(spark: SparkSession, m: Map) -> DataFrame:
    """(node, x, y, features) of the codebook."""
    rows = [(i, i % m.cols, i // m.cols, [float(v) for v in w]) for i, w in enumerate(m.nodes)]
    return spark.createDataFrame(rows, "node int, x int, y int, features array<double>")
