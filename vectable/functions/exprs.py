"""Scalar and vector expressions as Column builders (all evaluated in the JVM)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sq_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two array columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(sq_distance(a, b))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def vector_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def vector_multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def vector_scale(a: Column, factor: Column | float) -> Column:
    f = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.transform(a, lambda x: x * f)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def gaussian(x: Column) -> Column:
    return F.exp(-(x * x))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def softplus(x: Column) -> Column:
    """ln(1 + e^x), written so that large x does not overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


ACTIVATIONS = {
    "sigmoid": sigmoid,
    "gaussian": gaussian,
    "relu": relu,
    "tanh": F.tanh,
    "softplus": softplus,
    "identity": lambda x: x,
}


def activation(name: str, x: Column) -> Column:
    if name not in ACTIVATIONS:
        raise ValueError(f"unknown activation {name!r}")
    return ACTIVATIONS[name](x)


def log_softmax(values: Column) -> Column:
    """Log-softmax of an array column."""
    top = F.array_max(values)
    total = F.aggregate(F.transform(values, lambda v: F.exp(v - top)), F.lit(0.0), lambda s, v: s + v)
    return F.transform(values, lambda v: v - top - F.log(total))


def argmax(values: Column) -> Column:
    """0-based index of the largest element; the first one wins ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def neighbourhood(sq_dist: Column, width: Column | float) -> Column:
    """Gaussian neighbourhood exp(-d^2 / (2 w^2))."""
    w = width if isinstance(width, Column) else F.lit(float(width))
    return F.exp(-sq_dist / (F.lit(2.0) * w * w))


def decay(start: float, step: Column, time_constant: float) -> Column:
    """Exponential decay of a radius or rate."""
    return F.lit(float(start)) * F.exp(-step / F.lit(float(time_constant)))


def clamp(x: Column, low: Column | float | int, high: Column | float | int) -> Column:
    lo = low if isinstance(low, Column) else F.lit(low)
    hi = high if isinstance(high, Column) else F.lit(high)
    return F.least(F.greatest(x, lo), hi)


def to_polar(re: Column, im: Column) -> tuple[Column, Column]:
    return F.sqrt(re * re + im * im), F.atan2(im, re)


def to_cartesian(mag: Column, phase: Column) -> tuple[Column, Column]:
    return mag * F.cos(phase), mag * F.sin(phase)


# Cosine-series coefficients of the tapers (constant, first, second harmonic).
TAPER_COSINES = {
    "hanning": (math.sqrt(2.0 / 3.0), -math.sqrt(2.0 / 3.0), 0.0),
    "hamming": (0.54, -0.46, 0.0),
    "blackman": (0.42, -0.5, 0.08),
}
TAPERS = ("square", "triangle", *TAPER_COSINES)


def taper_values(name: str, size: int) -> list[float]:
    """Taper weights for one frame.

    Hanning is normalised to unit mean square, so that analysis and synthesis
    together reconstruct the signal.  The triangle peaks at size/2 - 1.
    """
    if name == "square":
        return [1.0] * size
    if name == "triangle":
        half = size // 2
        return [j / half if j < half - 1 else 1.0 - (j - (half - 1)) / half for j in range(size)]
    if name not in TAPER_COSINES:
        raise ValueError(f"unknown taper {name!r}")
    a, b, c = TAPER_COSINES[name]
    turn = 2.0 * math.pi / size
    return [a + b * math.cos(turn * j) + c * math.cos(2.0 * turn * j) for j in range(size)]


def taper(name: str, j: Column, size: int) -> Column:
    """The same weights as a closed-form expression of the sample index."""
    if name == "square":
        return F.lit(1.0)
    if name == "triangle":
        half = size // 2
        up, down = j / F.lit(float(half)), F.lit(1.0) - (j - (half - 1)) / F.lit(float(half))
        return F.when(j < half - 1, up).otherwise(down)
    if name not in TAPER_COSINES:
        raise ValueError(f"unknown taper {name!r}")
    a, b, c = TAPER_COSINES[name]
    turn = F.lit(2.0 * math.pi / size) * j
    return F.lit(a) + F.lit(b) * F.cos(turn) + F.lit(c) * F.cos(turn * 2.0)


def array_literal(values: Sequence[float]) -> Column:
    return F.expr("array(" + ",".join(double_literal(v) for v in values) + ")")


def double_literal(value: float) -> str:
    v = float(value)
    if not math.isfinite(v):
        raise ValueError("model contains a non-finite number")
    return f"({v!r}D)" if v < 0 else f"{v!r}D"


def affine(column: str, offset: Sequence[float], factor: Sequence[float]) -> Column:
    """(x - offset) * factor per element, unrolled so that it stays in generated code."""
    if len(offset) <= 256:
        terms = [
            f"({column}[{i}] - {double_literal(o)}) * {double_literal(f)}" for i, (o, f) in enumerate(zip(offset, factor))
        ]
        return F.expr("array(" + ",".join(terms) + ")")
    shifted = F.zip_with(F.col(column), array_literal(offset), lambda x, o: x - o)
    return F.zip_with(shifted, array_literal(factor), lambda x, f: x * f)


def linear(column: str, weights: Sequence[float], intercept: float = 0.0) -> Column:
    """Dot product with fixed weights plus an intercept."""
    if len(weights) <= 256:
        terms = [double_literal(intercept)] + [f"{column}[{i}] * {double_literal(w)}" for i, w in enumerate(weights)]
        return F.expr(" + ".join(terms))
    return dot(F.col(column), array_literal(weights)) + F.lit(float(intercept))
