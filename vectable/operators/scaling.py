"""Scalers: fit one aggregate, transform and inverse as projections."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.functions.blocks import matrix_udf
from vectable.functions.exprs import affine
from vectable.operators.layout import require_dim
from vectable.operators.moments import covariance, moments

SCALERS = ("standard", "min_max", "normalization", "abs", "pca_whitening", "zca_whitening")


@dataclass(frozen=True)
class Scaler:
    """x -> (x - offset) * factor, followed by an optional d x d matrix; ``back`` undoes it."""

    kind: str
    offset: np.ndarray
    factor: np.ndarray
    matrix: np.ndarray | None = None
    back: np.ndarray | None = None

    @property
    def dim(self) -> int:
        return len(self.offset)


def _safe(x: np.ndarray) -> np.ndarray:
    """A constant feature is left unscaled."""
    return np.where(x == 0.0, 1.0, x)


def fit_scaler(
    df: DataFrame,
    kind: str = "standard",
    *,
    low: float = 0.0,
    high: float = 1.0,
    epsilon: float = 5e-5,
    features_col: str = "features",
) -> Scaler:
    if kind not in SCALERS:
        raise ValueError(f"scaler is one of {SCALERS}")
    m = moments(df, features_col)
    one = np.ones_like(m.mean)
    if kind == "standard":
        return Scaler(kind, m.mean, one / _safe(m.std_pop))
    if kind == "min_max":
        if not low < high:
            raise ValueError("min_max needs min < max")
        factor = (high - low) / _safe(m.max - m.min)
        # low + (x - min) * factor, written as (x - offset) * factor.
        return Scaler(kind, m.min - low / factor, factor)
    if kind == "normalization":
        return Scaler(kind, m.mean, one / _safe(m.max - m.min))
    if kind == "abs":
        return Scaler(kind, np.zeros_like(m.mean), one / _safe(m.max_abs))
    _, cov = covariance(df, features_col, m)
    values, vectors = np.linalg.eigh(cov)
    root = np.sqrt(np.maximum(values, 0.0) + epsilon)
    whiten = (vectors / root).T
    color = vectors * root
    if kind == "zca_whitening":
        whiten, color = vectors @ whiten, color @ vectors.T
    return Scaler(kind, m.mean, one, whiten, color)


def scale(df: DataFrame, scaler: Scaler, features_col: str = "features", output_col: str | None = None) -> DataFrame:
    """Scaled features; every other column stays."""
    checked = require_dim(df, scaler.dim, features_col)
    if scaler.matrix is None:
        expr = affine(features_col, scaler.offset, scaler.factor)
    else:
        offset, factor, matrix = scaler.offset, scaler.factor, scaler.matrix
        expr = matrix_udf(lambda x: ((x - offset) * factor) @ matrix.T)(F.col(features_col))
    return checked.withColumn(output_col or features_col, expr)


def unscale(df: DataFrame, scaler: Scaler, features_col: str = "features", output_col: str | None = None) -> DataFrame:
    """Undo :func:`scale`."""
    checked = require_dim(df, scaler.dim, features_col)
    if scaler.back is None:
        # x = y / factor + offset
        expr = affine(features_col, -scaler.offset * scaler.factor, 1.0 / scaler.factor)
    else:
        offset, factor, back = scaler.offset, scaler.factor, scaler.back
        expr = matrix_udf(lambda y: (y @ back.T) / factor + offset)(F.col(features_col))
    return checked.withColumn(output_col or features_col, expr)


def scale_matrix(scaler: Scaler, x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The same on a model-sized matrix (centroids, codebooks, generated parameters)."""
    if inverse:
        y = x if scaler.back is None else x @ scaler.back.T
        return y / scaler.factor + scaler.offset
    y = (x - scaler.offset) * scaler.factor
    return y if scaler.matrix is None else y @ scaler.matrix.T


def fit_scale(df: DataFrame, kind: str = "standard", **options: float) -> tuple[Scaler, DataFrame]:
    """Fit, and return the scaled training set as well."""
    scaler = fit_scaler(df, kind, **options)
    return scaler, scale(df, scaler, options.get("features_col", "features"))


class ScalerSlot:
    """A scaler setting and its fit; changing the setting drops the fit."""

    def __init__(self, kind: str = "standard", **options: float):
        self.kind, self.options, self.fitted = kind, options, None

    def set_kind(self, kind: str) -> None:
        if kind != self.kind:
            self.kind, self.fitted = kind, None

    def fit(self, df: DataFrame) -> DataFrame:
        self.fitted, scaled = fit_scale(df, self.kind, **self.options)
        return scaled

    def transform(self, df: DataFrame, inverse: bool = False) -> DataFrame:
        if self.fitted is None:
            raise ValueError("fit the scaler first (a changed scaler type needs a new fit)")
        return unscale(df, self.fitted) if inverse else scale(df, self.fitted)


@dataclass(frozen=True)
class Autoscaled:
    """A model with the scaler its training data went through."""

    scaler: Scaler
    model: object


def fit_autoscaled(df: DataFrame, fit: Callable[[DataFrame], object], kind: str = "normalization", **options: float) -> Autoscaled:
    """Scale the training data, then fit any model on it."""
    scaler, scaled = fit_scale(df, kind, **options)
    return Autoscaled(scaler, fit(scaled))


def apply_autoscaled(df: DataFrame, fitted: Autoscaled, apply: Callable[[DataFrame, object], DataFrame]) -> DataFrame:
    """Scale the query with the training scaler, then apply the model."""
    return apply(scale(df, fitted.scaler), fitted.model)


def restore_autoscaled(df: DataFrame, fitted: Autoscaled, features_col: str = "features") -> DataFrame:
    """Bring what a model generated or decoded back to the scale of the training data."""
    return unscale(df, fitted.scaler, features_col)
