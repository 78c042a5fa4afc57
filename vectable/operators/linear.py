"""Linear and ridge regression from one pass of normal equations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.blocks import sum_over_rows
from vectable.functions.exprs import linear
from vectable.operators.moments import moments


@dataclass(frozen=True)
class LinearModel:
    intercept: float
    coefficients: np.ndarray
    mse: float


def fit_linear(df: DataFrame, target_col: str = "target", lam: float = 0.0) -> LinearModel:
    """Least squares with intercept; ``lam`` adds lam * |b|^2 over the coefficients, not the intercept.

    Rows are centred before they are multiplied, so the intercept drops out of the
    system and large means cost no digits.
    """
    if lam < 0:
        raise ValueError("lambda must not be negative")
    m = moments(df)
    mean_y = df.agg(F.avg(target_col)).first()[0]
    if mean_y is None:
        raise ValueError("no targets")

    def step(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        if np.isnan(y.astype(float)).any():
            raise ValueError("NULL or NaN target")
        z, t = x - m.mean, y.astype(float) - mean_y
        return {"xx": z.T @ z, "xy": z.T @ t, "yy": np.array((t * t).sum())}

    out = sum_over_rows(df, ["features", F.col(target_col).cast("double")], step)
    a = out["xx"] + lam * np.eye(len(m.mean))
    b = np.linalg.lstsq(a, out["xy"], rcond=None)[0]
    mse = (out["yy"].item() - 2.0 * b @ out["xy"] + b @ out["xx"] @ b) / m.n
    return LinearModel(float(mean_y - b @ m.mean), b, float(max(mse, 0.0)))


def predict_linear(df: DataFrame, model: LinearModel, output_col: str = "prediction") -> DataFrame:
    return df.withColumn(output_col, linear("features", model.coefficients, model.intercept))


def parameters(spark: SparkSession, model: LinearModel) -> DataFrame:
    """(position, value): the intercept first, then the coefficients."""
    rows = list(enumerate([model.intercept, *map(float, model.coefficients)]))
    return spark.createDataFrame([(i, float(v)) for i, v in rows], "position int, value double")
