"""Gaussian mixtures: training by EM, densities, classification and sampling."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.blocks import from_matrix, matrix_udf, nearest, sum_over_rows, to_matrix
from vectable.functions.hashing import normals, uniforms
from vectable.operators.clustering import kmeans
from vectable.operators.layout import shape
from vectable.operators.moments import moments
from vectable.session import reused

LOG_2PI = math.log(2.0 * math.pi)
#: The draw that picks a component; features take the draws 0, 1, ..
PICK = 1_000_000


@dataclass(frozen=True)
class Mixture:
    """Component weights (g), means (g, d) and covariances: (g, d) when diagonal, else (g, d, d)."""

    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray
    loglik: float = float("nan")
    iterations: int = 0

    @property
    def diagonal(self) -> bool:
        return self.covs.ndim == 2


def component_log_densities(model: Mixture, x: np.ndarray) -> np.ndarray:
    """ln N(x | component), shape (n, g)."""
    g, d = model.means.shape
    out = np.empty((len(x), g))
    for c in range(g):
        z = x - model.means[c]
        if model.diagonal:
            out[:, c] = -0.5 * (d * LOG_2PI + np.log(model.covs[c]).sum() + (z * z / model.covs[c]).sum(1))
        else:
            low = np.linalg.cholesky(model.covs[c])
            y = np.linalg.solve(low, z.T)
            out[:, c] = -0.5 * (d * LOG_2PI + (y * y).sum(0)) - np.log(np.diag(low)).sum()
    return out


def log_sum_exp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(a - top).sum(axis=axis)) + np.squeeze(top, axis)


def _weighted(model: Mixture, x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return component_log_densities(model, x) + np.log(model.weights)


def _positive(cov: np.ndarray, diagonal: bool, force: bool) -> np.ndarray:
    """Covariance that can be inverted: a floor on variances or eigenvalues."""
    if diagonal:
        return np.maximum(cov, 1e-10)
    if not force:
        return cov
    values, vectors = np.linalg.eigh(cov)
    floor = max(values.max() * 1e-10, 1e-10)
    return cov if values.min() > floor else (vectors * np.maximum(values, floor)) @ vectors.T


def _from_sums(total: np.ndarray, first: np.ndarray, second: np.ndarray, shift: np.ndarray, diagonal: bool, force: bool) -> Mixture:
    """Parameters from responsibilities, sums and squares of shifted rows."""
    safe = np.maximum(total, 1e-300)
    mu = first / safe[:, None]
    if diagonal:
        cov = second / safe[:, None] - mu * mu
    else:
        cov = second / safe[:, None, None] - mu[:, :, None] * mu[:, None, :]
    cov = np.stack([_positive(c, diagonal, force) for c in cov])
    return Mixture(total / total.sum(), mu + shift, cov)


def _squares(r: np.ndarray, z: np.ndarray, diagonal: bool) -> np.ndarray:
    if diagonal:
        return r.T @ (z * z)
    return np.stack([(z * r[:, [c]]).T @ z for c in range(r.shape[1])])


def em_step(df: DataFrame, model: Mixture, shift: np.ndarray, *, force_positive: bool = True, features_col: str = "features") -> Mixture:
    """One expectation-maximisation pass; ``loglik`` of the result belongs to the *input* parameters."""

    def step(x: np.ndarray) -> dict[str, np.ndarray]:
        joint = _weighted(model, x)
        norm = log_sum_exp(joint, 1)
        r = np.exp(joint - norm[:, None])
        z = x - shift
        return {"n": r.sum(0), "s": r.T @ z, "q": _squares(r, z, model.diagonal), "ll": np.array(norm.sum())}

    out = sum_over_rows(df, [features_col], step)
    new = _from_sums(out["n"], out["s"], out["q"], shift, model.diagonal, force_positive)
    return Mixture(new.weights, new.means, new.covs, float(out["ll"].item()))


def _from_centroids(df: DataFrame, centroids: np.ndarray, shift: np.ndarray, diagonal: bool, force: bool) -> Mixture:
    """Start parameters from hard k-means assignments."""

    def step(x: np.ndarray) -> dict[str, np.ndarray]:
        r = np.zeros((len(x), len(centroids)))
        r[np.arange(len(x)), nearest(x, centroids)[0]] = 1.0
        z = x - shift
        return {"n": r.sum(0), "s": r.T @ z, "q": _squares(r, z, diagonal)}

    out = sum_over_rows(df, ["features"], step)
    return _from_sums(out["n"], out["s"], out["q"], shift, diagonal, force)


def fit_mixture(
    df: DataFrame,
    gaussians: int = 10,
    *,
    trials: int = 1,
    max_iterations: int = 250,
    tolerance: float = 1e-5,
    diagonal_covariance: bool = True,
    no_force_positive: bool = False,
    kmeans_max_iterations: int = 1000,
    noise: float = 0.0,
    refined_start: bool = False,
    samplings: int = 100,
    percentage: float = 0.02,
    id_col: str = "row_id",
    seed: int = 0,
) -> Mixture:
    """EM from k-means; the best of ``trials`` starts by likelihood."""
    n, dim = shape(df)
    if n < gaussians:
        raise ValueError(f"{gaussians} Gaussians asked of {n} points")
    source = df
    if noise:

        @F.arrow_udf("array<double>")
        def noisy(ids: pa.Array, x: pa.Array) -> pa.Array:
            return from_matrix(to_matrix(x) + noise * np.stack([normals(seed, j, ids.to_numpy()) for j in range(dim)], 1)) if len(ids) else from_matrix(np.empty((0, dim)))

        source = df.withColumn("features", noisy(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-1)), F.col("features")))
    shift = moments(source).mean
    best: Mixture | None = None
    with reused(source, id_col, "features") as kept:
        for trial in range(max(1, trials)):
            start = kmeans(
                kept, gaussians, max_iterations=kmeans_max_iterations, refined=refined_start, samplings=samplings,
                percentage=percentage, empty="allow", id_col=id_col, seed=seed + trial,
            )
            model = _from_centroids(kept, start.centroids, shift, diagonal_covariance, not no_force_positive)
            last, done = -math.inf, 0
            while done < max(1, max_iterations):
                new = em_step(kept, model, shift, force_positive=not no_force_positive)
                done += 1
                scored = Mixture(model.weights, model.means, model.covs, new.loglik, done)
                if abs(new.loglik - last) < tolerance:
                    break
                last, model = new.loglik, new
            if best is None or scored.loglik > best.loglik:
                best = scored
    return best


def normalised_weights(weights: list[float] | np.ndarray | None, components: int) -> np.ndarray:
    """User weights scaled to sum to one; uniform when none are given."""
    if weights is None:
        return np.full(components, 1.0 / components)
    w = np.asarray(weights, dtype=float)
    if len(w) != components:
        raise ValueError(f"{len(w)} weights for {components} components")
    if np.any(w < 0) or w.sum() <= 0:
        raise ValueError("weights must be non-negative and not all zero")
    return w / w.sum()


def score(df: DataFrame, model: Mixture, features_col: str = "features", output_col: str = "log_prob") -> DataFrame:
    """Log-density of each point under the mixture."""
    return df.withColumn(output_col, matrix_udf(lambda x: log_sum_exp(_weighted(model, x), 1), "double")(F.col(features_col)))


def classify(df: DataFrame, model: Mixture, features_col: str = "features", output_col: str = "component") -> DataFrame:
    """Component with the largest weighted density; the first one wins ties."""
    return df.withColumn(output_col, matrix_udf(lambda x: _weighted(model, x).argmax(1), "int")(F.col(features_col)))


def generate(
    spark: SparkSession,
    model: Mixture,
    n: int,
    *,
    component: int | None = None,
    weights: list[float] | None = None,
    seed: int = 0,
) -> DataFrame:
    """(row_id, component, features): draws made where they are stored, each from (seed, row_id).

    ``component`` draws from one Gaussian only (clamped to a valid one); ``weights``
    replaces the fitted mixing weights.
    """
    g, d = model.means.shape
    picked = None if component is None else min(max(int(component), 0), g - 1)
    w = model.weights if weights is None else normalised_weights(weights, g)
    edges = np.cumsum(w)[:-1]
    roots = np.stack([np.diag(np.sqrt(c)) if model.diagonal else np.linalg.cholesky(c) for c in model.covs])
    means = model.means

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if picked is None:
                c = np.searchsorted(edges, uniforms(seed, PICK, ids), "right")
            else:
                c = np.full(len(ids), picked)
            z = np.stack([normals(seed, j, ids) for j in range(d)], 1)
            drawn = means[c] + np.einsum("nij,nj->ni", roots[c], z)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(c.astype(np.int32)), from_matrix(drawn)], ["row_id", "component", "features"])

    return spark.range(n).mapInArrow(run, "row_id bigint, component int, features array<double>")
