"""Feed-forward networks and the sparse autoencoder."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.functions.blocks import Batch, Partials, matrix_udf, sum_over_tasks
from vectable.functions.exprs import argmax
from vectable.operators.layout import require_contiguous_labels, require_dim, shape
from vectable.operators.training import lbfgs, minimise, no_penalty
from vectable.session import reused


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


# name -> (activation, its derivative in terms of the pre-activation)
ACTIVATIONS = {
    "sigmoid": (_sigmoid, lambda x: _sigmoid(x) * (1.0 - _sigmoid(x))),
    "gaussian": (lambda x: np.exp(-x * x), lambda x: -2.0 * x * np.exp(-x * x)),
    "relu": (lambda x: np.maximum(x, 0.0), lambda x: (x > 0).astype(float)),
    "tanh": (np.tanh, lambda x: 1.0 - np.tanh(x) ** 2),
    "softplus": (lambda x: np.logaddexp(0.0, x), _sigmoid),
    "identity": (lambda x: x, np.ones_like),
}


@dataclass(frozen=True)
class Network:
    """Layer widths (input first) and one flat parameter vector: per layer the weights (out x in), then biases."""

    widths: tuple[int, ...]
    activation: str
    theta: np.ndarray
    classifier: bool
    loss: float = float("nan")

    def layers(self, theta: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        t = self.theta if theta is None else theta
        out, at = [], 0
        for fan_in, fan_out in zip(self.widths, self.widths[1:]):
            w = t[at : at + fan_in * fan_out].reshape(fan_out, fan_in)
            at += fan_in * fan_out
            out.append((w, t[at : at + fan_out]))
            at += fan_out
        return out

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Network output; log-softmax for a classifier."""
        act = ACTIVATIONS[self.activation][0]
        layers = self.layers()
        for i, (w, b) in enumerate(layers):
            x = x @ w.T + b
            if i + 1 < len(layers):
                x = act(x)
        return _log_softmax(x) if self.classifier else x


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def start_network(widths: tuple[int, ...], activation: str, classifier: bool, seed: int) -> Network:
    """Uniform start in +-sqrt(6 / (in + out)), zero biases."""
    if activation not in ACTIVATIONS:
        raise ValueError(f"activation is one of {tuple(ACTIVATIONS)}")
    rng, parts = np.random.default_rng(seed), []
    for fan_in, fan_out in zip(widths, widths[1:]):
        r = math.sqrt(6.0 / (fan_in + fan_out))
        parts += [rng.uniform(-r, r, fan_in * fan_out), np.zeros(fan_out)]
    return Network(widths, activation, np.concatenate(parts), classifier)


def _row_loss(net: Network):
    """Summed loss of a batch and its gradient by back-propagation."""
    act, slope = ACTIVATIONS[net.activation]

    def loss(theta: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        layers = net.layers(theta)
        inputs, pre = [x], []
        for i, (w, b) in enumerate(layers):
            pre.append(inputs[-1] @ w.T + b)
            inputs.append(act(pre[-1]) if i + 1 < len(layers) else pre[-1])
        if net.classifier:
            logp = _log_softmax(pre[-1])
            at = np.arange(len(x)), y.astype(int)
            value = -float(logp[at].sum())
            delta = np.exp(logp)
            delta[at] -= 1.0
        else:
            target = y if y.ndim == 2 else y[:, None]
            diff = pre[-1] - target
            value = float((diff * diff).sum() / diff.shape[1])
            delta = 2.0 * diff / diff.shape[1]
        grads = []
        for i in range(len(layers) - 1, -1, -1):
            grads.append(np.concatenate([(delta.T @ inputs[i]).reshape(-1), delta.sum(0)]))
            if i:
                delta = (delta @ layers[i][0]) * slope(pre[i - 1])
        return value, np.concatenate(grads[::-1])

    return loss


def _fit(df: DataFrame, target_col: str, net: Network, *, optimizer: str, step_size: float, batch_size: int, max_iterations: int, tolerance: float, seed: int, batches: int) -> Network:
    if optimizer not in ("rmsprop", "sgd", "lbfgs", "adam"):
        raise ValueError("optimizer is rmsprop, sgd, lbfgs or adam")
    # Full gradients pack the table themselves.
    with nullcontext(df) if optimizer == "lbfgs" else reused(df, "features", target_col) as kept:
        theta, value, _ = minimise(
            kept, ["features", target_col], net.theta, _row_loss(net), no_penalty, optimizer=optimizer,
            max_iterations=max_iterations, tolerance=tolerance, step_size=step_size, batch_size=batch_size, seed=seed, batches=batches,
        )
    return Network(net.widths, net.activation, theta, net.classifier, value)


def fit_classifier(
    df: DataFrame,
    label_col: str = "label",
    *,
    hidden_layers: int = 1,
    hidden_neurons: int = 1,
    activation: str = "relu",
    optimizer: str = "rmsprop",
    step_size: float = 0.01,
    batch_size: int = 50,
    max_iterations: int = 10000,
    tolerance: float = 1e-7,
    seed: int = 0,
    batches: int = 0,
) -> Network:
    """Hidden layers, then one log-softmax output per class; labels are 0 .. k-1.

    ``batches`` asks for so many global batches a pass, whose result does not depend on partitions.
    """
    k = require_contiguous_labels(df, label_col)
    _, d = shape(df)
    net = start_network((d, *[hidden_neurons] * hidden_layers, k), activation, True, seed)
    return _fit(
        df, label_col, net, optimizer=optimizer, step_size=step_size, batch_size=batch_size,
        max_iterations=max_iterations, tolerance=tolerance, seed=seed, batches=batches,
    )


def fit_regressor(
    df: DataFrame,
    target_col: str = "target",
    *,
    outputs: int = 1,
    hidden_layers: int = 1,
    hidden_neurons: int = 1,
    activation: str = "relu",
    optimizer: str = "rmsprop",
    step_size: float = 0.01,
    batch_size: int = 50,
    max_iterations: int = 10000,
    tolerance: float = 1e-7,
    seed: int = 0,
    batches: int = 0,
) -> Network:
    """The same with a linear output and mean squared error; the target is a number or an array."""
    _, d = shape(df)
    net = start_network((d, *[hidden_neurons] * hidden_layers, outputs), activation, False, seed)
    return _fit(
        df, target_col, net, optimizer=optimizer, step_size=step_size, batch_size=batch_size,
        max_iterations=max_iterations, tolerance=tolerance, seed=seed, batches=batches,
    )


def apply_network(df: DataFrame, net: Network, output_col: str = "output") -> DataFrame:
    """Adds the outputs, and for a classifier the predicted label (the first maximum)."""
    scored = require_dim(df, net.widths[0]).withColumn(output_col, matrix_udf(net.forward)(F.col("features")))
    return scored.withColumn("prediction", argmax(F.col(output_col))) if net.classifier else scored


# --- sparse autoencoder ---------------------------------------------------------


@dataclass(frozen=True)
class Autoencoder:
    """h = s(W1 x + b1), x' = s(W2 h + b2)."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    cost: float = float("nan")

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w1.reshape(-1), self.b1, self.w2.reshape(-1), self.b2])


def _unflatten(theta: np.ndarray, v: int, h: int) -> Autoencoder:
    a, b, c = h * v, h * v + h, h * v + h + v * h
    return Autoencoder(theta[:a].reshape(h, v), theta[a:b], theta[b:c].reshape(v, h), theta[c:])


def autoencoder_cost(df: DataFrame, model: Autoencoder, *, lam: float, beta: float, rho: float) -> tuple[float, np.ndarray]:
    """Half mean squared error + weight decay + sparsity divergence, with the gradient, in one pass.

    The divergence depends on the mean activation over all rows, so its gradient is
    kept as a separate sum per hidden unit and weighted once the mean is known.
    """
    h, v = model.w1.shape

    def task(batches: Iterator[Batch]) -> Partials:
        out: Partials = {}
        for (x,) in batches:
            hid = _sigmoid(x @ model.w1.T + model.b1)
            rec = _sigmoid(hid @ model.w2.T + model.b2)
            diff = rec - x
            d2 = diff * rec * (1.0 - rec)
            slope = hid * (1.0 - hid)
            d1 = (d2 @ model.w2) * slope
            one = np.hstack([x, np.ones((len(x), 1))])
            part = {
                "n": np.array(float(len(x))), "sse": np.array((diff * diff).sum()), "rho": hid.sum(0), "g1": d1.T @ one,
                "k1": slope.T @ one, "g2": d2.T @ np.hstack([hid, np.ones((len(x), 1))]),
            }
            out = {k: out[k] + p for k, p in part.items()} if out else part
        return out

    s = sum_over_tasks(df, ["features"], task)
    n = s["n"].item()
    mean = np.clip(s["rho"] / n, 1e-12, 1.0 - 1e-12)
    kl = float((rho * np.log(rho / mean) + (1.0 - rho) * np.log((1.0 - rho) / (1.0 - mean))).sum())
    pull = beta * (-rho / mean + (1.0 - rho) / (1.0 - mean))
    g1 = s["g1"] / n + pull[:, None] * s["k1"] / n
    g2 = s["g2"] / n
    decay = float((model.w1**2).sum() + (model.w2**2).sum())
    cost = 0.5 * s["sse"].item() / n + 0.5 * lam * decay + beta * kl
    grad = np.concatenate(
        [(g1[:, :v] + lam * model.w1).reshape(-1), g1[:, v], (g2[:, :h] + lam * model.w2).reshape(-1), g2[:, h]]
    )
    return cost, grad


def fit_autoencoder(
    df: DataFrame,
    hidden_size: int = 2,
    *,
    lam: float = 1e-4,
    beta: float = 3.0,
    rho: float = 0.01,
    max_iterations: int = 100,
    tolerance: float = 1e-6,
    seed: int = 0,
) -> Autoencoder:
    _, v = shape(df)
    r = math.sqrt(6.0) / math.sqrt(v + hidden_size + 1)
    rng = np.random.default_rng(seed)
    start = Autoencoder(
        rng.uniform(-r, r, (hidden_size, v)), np.zeros(hidden_size), rng.uniform(-r, r, (v, hidden_size)), np.zeros(v)
    )
    with reused(df, "features") as kept:
        theta, cost, _ = lbfgs(
            lambda t: autoencoder_cost(kept, _unflatten(t, v, hidden_size), lam=lam, beta=beta, rho=rho),
            start.flat(), max_iterations, tolerance,
        )
    m = _unflatten(theta, v, hidden_size)
    return Autoencoder(m.w1, m.b1, m.w2, m.b2, cost)


def encode(df: DataFrame, model: Autoencoder, features_col: str = "features", output_col: str = "hidden") -> DataFrame:
    w, b = model.w1, model.b1
    return require_dim(df, w.shape[1], features_col).withColumn(output_col, matrix_udf(lambda x: _sigmoid(x @ w.T + b))(F.col(features_col)))


def decode(df: DataFrame, model: Autoencoder, hidden_col: str = "hidden", output_col: str = "decoded") -> DataFrame:
    w, b = model.w2, model.b2
    return require_dim(df, w.shape[1], hidden_col).withColumn(output_col, matrix_udf(lambda x: _sigmoid(x @ w.T + b))(F.col(hidden_col)))
