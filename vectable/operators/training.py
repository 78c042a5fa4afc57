"""Fitting parameter vectors: distributed gradients with a driver-side L-BFGS, or averaged mini-batch passes.

Either way one pass over the table is one Spark job and only parameter-sized
arrays travel.  Where the result must not depend on partitions, a pass has a number
of global batches, with one job and one step each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.functions.blocks import Batch, Packed, Partials, packed, sum_over_tasks
from vectable.session import reused

ValueGrad = Callable[[np.ndarray], tuple[float, np.ndarray]]
RowLoss = Callable[..., tuple[float, np.ndarray]]


def lbfgs(objective: ValueGrad, theta: np.ndarray, max_iterations: int, tolerance: float, memory: int = 10) -> tuple[np.ndarray, float, int]:
    """Limited-memory quasi-Newton with a backtracking line search; each evaluation is one pass."""
    value, grad = objective(theta)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    while done < max_iterations and np.sqrt(grad @ grad) > tolerance:
        q, stack = grad.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            stack.append(a)
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.sqrt(grad @ grad))
        for (s, y), a in zip(pairs, reversed(stack)):
            q += (a - (y @ q) / (s @ y)) * s
        slope = -(grad @ q)
        if slope >= 0:
            pairs, q, slope = [], grad.copy(), -(grad @ grad)
        rate, moved = 1.0, None
        for _ in range(20):
            trial = theta - rate * q
            new_value, new_grad = objective(trial)
            if np.isfinite(new_value) and new_value <= value + 1e-4 * rate * slope:
                moved = trial
                break
            rate *= 0.5
        done += 1
        if moved is None:
            break
        s, y = moved - theta, new_grad - grad
        if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
            pairs = [*pairs[1 - memory :], (s, y)] if memory > 1 else [(s, y)]
        small = abs(value - new_value) <= tolerance * max(abs(value), abs(new_value), 1.0)
        theta, value, grad = moved, new_value, new_grad
        if small:
            break
    return theta, float(value), done


def mean_objective(df: DataFrame | Packed, columns: list[str | Column], row_loss: RowLoss, penalty: ValueGrad) -> ValueGrad:
    """Mean row loss over the table plus a penalty, with its gradient."""

    def objective(theta: np.ndarray) -> tuple[float, np.ndarray]:
        def task(batches: Iterator[Batch]) -> Partials:
            n, loss, grad = 0, 0.0, np.zeros_like(theta)
            for batch in batches:
                part, g = row_loss(theta, *batch)
                n, loss, grad = n + len(batch[0]), loss + part, grad + g
            return {"n": np.array(float(n)), "loss": np.array(loss), "grad": grad} if n else {}

        out = sum_over_tasks(df, columns, task)
        n = out["n"].item()
        p, pg = penalty(theta)
        return out["loss"].item() / n + p, out["grad"] / n + pg

    return objective


class Stepper:
    """One parameter update rule; the moments live for one pass of one task."""

    def __init__(self, kind: str, rate: float, size: int):
        if kind not in ("sgd", "psgd", "adam", "rmsprop"):
            raise ValueError(f"unknown optimizer {kind!r}")
        self.kind, self.rate, self.t = kind, rate, 0
        self.first, self.second = np.zeros(size), np.zeros(size)

    def __call__(self, theta: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        if self.kind in ("sgd", "psgd"):
            return theta - self.rate * grad
        if self.kind == "rmsprop":
            self.second = 0.99 * self.second + 0.01 * grad * grad
            return theta - self.rate * grad / (np.sqrt(self.second) + 1e-8)
        self.first = 0.9 * self.first + 0.1 * grad
        self.second = 0.999 * self.second + 0.001 * grad * grad
        m, v = self.first / (1.0 - 0.9**self.t), self.second / (1.0 - 0.999**self.t)
        return theta - self.rate * m / (np.sqrt(v) + 1e-8)


def averaged_passes(
    df: DataFrame,
    columns: list[str | Column],
    theta: np.ndarray,
    row_loss: RowLoss,
    penalty: ValueGrad,
    *,
    optimizer: str,
    step_size: float,
    batch_size: int,
    epochs: int,
    tolerance: float,
    shuffle: bool = False,
    seed: int = 0,
) -> tuple[np.ndarray, float, int]:
    """Parallel mini-batch descent: every task walks its rows once, then the parameters are averaged by row count.

    The loss of a pass is the one met on the way; passes stop when it no longer changes.
    Results depend on how rows are split over tasks, as any mini-batch order would.
    """
    last, value, done = np.inf, np.inf, 0
    for epoch in range(epochs):
        start = theta

        def task(batches: Iterator[Batch]) -> Partials:
            here, n, loss = start.copy(), 0, 0.0
            step = Stepper(optimizer, step_size, len(start))
            rng = np.random.default_rng((seed, epoch))
            for batch in batches:
                rows = len(batch[0])
                order = rng.permutation(rows) if shuffle else np.arange(rows)
                for lo in range(0, rows, batch_size):
                    pick = order[lo : lo + batch_size]
                    part, grad = row_loss(here, *[c[pick] for c in batch])
                    here = step(here, grad / len(pick) + penalty(here)[1])
                    loss += part
                n += rows
            return {"n": np.array(float(n)), "loss": np.array(loss), "theta": here * n} if n else {}

        out = sum_over_tasks(df, columns, task)
        n = out["n"].item()
        theta, value, done = out["theta"] / n, out["loss"].item() / n + penalty(start)[0], epoch + 1
        if abs(last - value) <= tolerance * max(1.0, abs(value)):
            break
        last = value
    return theta, float(value), done


def dealt_batches(columns: list[str | Column], batches: int, seed: int) -> Column:
    """The batch of a row by a hash of its values: equal rows share one, and partitions play no part."""
    values = [c if isinstance(c, Column) else F.col(c) for c in columns]
    return F.pmod(F.xxhash64(F.lit(int(seed)), *values), F.lit(int(batches)))


def global_passes(
    df: DataFrame,
    columns: list[str | Column],
    theta: np.ndarray,
    row_loss: RowLoss,
    penalty: ValueGrad,
    *,
    optimizer: str,
    step_size: float,
    batches: int,
    epochs: int,
    tolerance: float,
    seed: int = 0,
    batch_of: Column | None = None,
) -> tuple[np.ndarray, float, int]:
    """Mini-batch descent with one step for all tasks per batch: the gradients of a batch's rows are summed over the table.

    Rows belong to one of ``batches`` batches by a hash of their values, or by ``batch_of``, so
    the result does not depend on how they are partitioned.  A step is one job over the rows of its
    batch, which lie together in the kept table; the moments of the optimiser live as long as the fit.
    """
    if batches < 1:
        raise ValueError("a pass has at least one batch")
    named = {f"__{i}": c if isinstance(c, Column) else F.col(c) for i, c in enumerate(columns)}
    deal = dealt_batches(columns, batches, seed) if batch_of is None else batch_of
    dealt = df.select(*[c.alias(n) for n, c in named.items()], deal.cast("int").alias("__batch")).sortWithinPartitions("__batch")
    step = Stepper(optimizer, step_size, len(theta))
    last, value, done = np.inf, np.inf, 0
    with reused(dealt, *named, "__batch") as kept:
        for epoch in range(epochs):
            start, rows, loss = theta, 0.0, 0.0
            for batch in range(batches):
                here = theta

                def task(parts: Iterator[Batch], here: np.ndarray = here) -> Partials:
                    n, total, grad = 0, 0.0, np.zeros_like(here)
                    for part in parts:
                        value, g = row_loss(here, *part)
                        n, total, grad = n + len(part[0]), total + value, grad + g
                    return {"n": np.array(float(n)), "loss": np.array(total), "grad": grad} if n else {}

                out = sum_over_tasks(kept.filter(F.col("__batch") == batch), list(named), task)
                if not out:
                    continue
                n = out["n"].item()
                theta = step(here, out["grad"] / n + penalty(here)[1])
                rows, loss = rows + n, loss + out["loss"].item()
            if not rows:
                raise ValueError("no rows to learn from")
            value, done = loss / rows + penalty(start)[0], epoch + 1
            if abs(last - value) <= tolerance * max(1.0, abs(value)):
                break
            last = value
    return theta, float(value), done


def minimise(
    df: DataFrame,
    columns: list[str | Column],
    theta: np.ndarray,
    row_loss: RowLoss,
    penalty: ValueGrad,
    *,
    optimizer: str,
    max_iterations: int,
    tolerance: float,
    step_size: float = 0.01,
    batch_size: int = 50,
    shuffle: bool = False,
    seed: int = 0,
    batches: int = 0,
) -> tuple[np.ndarray, float, int]:
    """L-BFGS on the full gradient, or mini-batch passes; ``max_iterations`` counts passes.

    With ``batches`` a pass has so many steps, each for all tasks; without, every task walks its own rows and parameters are averaged.
    """
    if optimizer == "lbfgs":
        with packed(df, columns) as blocks:
            return lbfgs(mean_objective(blocks, columns, row_loss, penalty), theta, max_iterations, tolerance)
    if batches:
        return global_passes(
            df, columns, theta, row_loss, penalty, optimizer=optimizer, step_size=step_size, batches=batches, epochs=max_iterations, tolerance=tolerance, seed=seed
        )
    return averaged_passes(
        df, columns, theta, row_loss, penalty, optimizer=optimizer, step_size=step_size, batch_size=batch_size,
        epochs=max_iterations, tolerance=tolerance, shuffle=shuffle, seed=seed,
    )


def no_penalty(theta: np.ndarray) -> tuple[float, np.ndarray]:
    return 0.0, np.zeros_like(theta)
