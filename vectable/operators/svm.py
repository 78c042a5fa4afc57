"""Multiclass linear support vector machine and label normalisation."""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.functions.blocks import matrix_udf
from vectable.functions.exprs import argmax
from vectable.operators.joins import join_unique
from vectable.operators.layout import require_dim, shape
from vectable.operators.order import row_index
from vectable.operators.training import minimise
from vectable.session import reused


def label_map(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, class): arbitrary labels to 0 .. k-1 in label order; one row per class."""
    labels = df.select(F.col(label_col).alias("label")).where(F.col("label").isNotNull()).distinct()
    return row_index(labels, ["label"], "class").select("label", F.col("class").cast("int").alias("class"))


def normalise_labels(df: DataFrame, mapping: DataFrame, label_col: str = "label", output_col: str = "class") -> DataFrame:
    """Class of each label; a label that most rows carry does not slow the join."""
    return join_unique(df, mapping.select(F.col("label").alias(label_col), F.col("class").alias(output_col)), label_col)


def revert_labels(df: DataFrame, mapping: DataFrame, class_col: str = "class", output_col: str = "label") -> DataFrame:
    return join_unique(df, mapping.select(F.col("class").alias(class_col), F.col("label").alias(output_col)), class_col)


@dataclass(frozen=True)
class LinearSvm:
    weights: np.ndarray  # (classes, d)
    intercepts: np.ndarray  # (classes,)
    objective: float = float("nan")


def row_loss(k: int, d: int, delta: float, intercept: bool):
    """Summed hinge loss of rows and its gradient, for weights with the intercept last."""

    def loss(theta: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        w = theta.reshape(k, d + intercept)
        z = np.hstack([x, np.ones((len(x), 1))]) if intercept else x
        s = z @ w.T
        at = np.arange(len(x)), y.astype(int)
        margin = np.maximum(s - s[at][:, None] + delta, 0.0)
        margin[at] = 0.0
        active = (margin > 0).astype(float)
        active[at] = -active.sum(1)
        return float(margin.sum()), (active.T @ z).reshape(-1)

    return loss


def fit_svm(
    df: DataFrame,
    class_col: str = "class",
    *,
    num_classes: int = 0,
    lam: float = 1e-4,
    delta: float = 1.0,
    no_intercept: bool = False,
    optimizer: str = "lbfgs",
    tolerance: float = 1e-10,
    max_iterations: int = 10000,
    step_size: float = 0.01,
    shuffle: bool = False,
    epochs: int = 50,
    batches: int = 0,
) -> LinearSvm:
    """Mean hinge loss with margin ``delta`` over all wrong classes plus lam/2 |W|^2; classes are 0 .. k-1.

    ``batches`` asks for so many global batches a pass, whose result does not depend on partitions.
    """
    if optimizer not in ("lbfgs", "psgd"):
        raise ValueError("optimizer is lbfgs or psgd")
    _, d = shape(df)
    k = num_classes or int(df.agg(F.max(class_col)).first()[0]) + 1
    if k < 2:
        raise ValueError("at least two classes are needed")
    intercept = not no_intercept

    def penalty(theta: np.ndarray) -> tuple[float, np.ndarray]:
        return 0.5 * lam * float(theta @ theta), lam * theta

    # Full gradients pack the table themselves.
    with nullcontext(df) if optimizer == "lbfgs" else reused(df, "features", class_col) as kept:
        theta, value, _ = minimise(
            kept, ["features", class_col], np.zeros(k * (d + intercept)), row_loss(k, d, delta, intercept), penalty,
            optimizer=optimizer, max_iterations=max_iterations if optimizer == "lbfgs" else epochs, tolerance=tolerance,
            step_size=step_size, shuffle=shuffle, batches=batches,
        )
    w = theta.reshape(k, d + intercept)
    return LinearSvm(w[:, :d], w[:, d] if intercept else np.zeros(k), value)


def svm_scores(df: DataFrame, model: LinearSvm) -> DataFrame:
    """Adds ``scores`` (one per class) and ``prediction``."""
    w, b = model.weights, model.intercepts
    scored = require_dim(df, w.shape[1]).withColumn("scores", matrix_udf(lambda x: x @ w.T + b)(F.col("features")))
    return scored.withColumn("prediction", argmax(F.col("scores")))
