"""Per-feature moments, Gram and covariance matrices: one scan, model-sized results."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.blocks import sum_over_rows


@dataclass(frozen=True)
class Moments:
    n: int
    mean: np.ndarray
    var_samp: np.ndarray
    min: np.ndarray
    max: np.ndarray

    @property
    def std_pop(self) -> np.ndarray:
        return np.sqrt(self.var_samp * max(0, self.n - 1) / self.n)

    @property
    def std_samp(self) -> np.ndarray:
        return np.sqrt(self.var_samp)

    @property
    def max_abs(self) -> np.ndarray:
        return np.maximum(np.abs(self.min), np.abs(self.max))


def moments(df: DataFrame, features_col: str = "features") -> Moments:
    """Mean, variance, minimum and maximum per feature, aggregated in the JVM."""
    stats = Summarizer.metrics("count", "mean", "variance", "min", "max")
    row = df.select(stats.summary(array_to_vector(F.col(features_col))).alias("s")).select("s.*").first()
    if row is None or not row["count"]:
        raise ValueError("empty feature table")
    out = Moments(int(row["count"]), *[row[c].toArray() for c in ("mean", "variance", "min", "max")])
    if not np.all(np.isfinite(out.mean)):
        raise ValueError("NaN or infinite feature value")
    return out


def moments_table(df: DataFrame, features_col: str = "features") -> DataFrame:
    m = moments(df, features_col)
    rows = [
        (i, float(m.mean[i]), float(m.std_pop[i]), float(m.min[i]), float(m.max[i]), float(m.max_abs[i]))
        for i in range(len(m.mean))
    ]
    return df.sparkSession.createDataFrame(rows, "feature_idx int, mean double, std double, min double, max double, max_abs double")


def gram(df: DataFrame, features_col: str = "features", shift: np.ndarray | None = None) -> tuple[int, np.ndarray]:
    """(rows, sum of x x^T), optionally of shifted rows."""

    def step(x: np.ndarray) -> dict[str, np.ndarray]:
        z = x if shift is None else x - shift
        return {"n": np.array(float(len(z))), "gram": z.T @ z}

    out = sum_over_rows(df, [features_col], step)
    if not out:
        raise ValueError("empty feature table")
    return int(out["n"].item()), out["gram"]


def covariance(df: DataFrame, features_col: str = "features", m: Moments | None = None) -> tuple[Moments, np.ndarray]:
    """Sample covariance; rows are centred before they are multiplied, so large means cost no digits."""
    m = moments(df, features_col) if m is None else m
    n, g = gram(df, features_col, m.mean)
    return m, g / max(1, n - 1)


def matrix_table(spark: SparkSession, matrix: np.ndarray, value: str = "value") -> DataFrame:
    """A model-sized matrix as (i, j, value) rows."""
    rows = [(i, j, float(matrix[i, j])) for i in range(matrix.shape[0]) for j in range(matrix.shape[1])]
    return spark.createDataFrame(rows, f"i int, j int, {value} double")
