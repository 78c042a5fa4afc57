"""Hidden Markov models over tables of observation sequences (seq, t, features[, state]).

Sequences are cut into chunks of bounded length.  Short sequences are one chunk each
and need no exchange; longer ones pass state vectors between chunks by prefix products.
Inside a task many chunks advance together, one time step at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions.blocks import PARTIAL_SCHEMA, Partials, add_partials, from_matrix, matrix_udf, partial_rows, sum_over_rows
from vectable.functions.hashing import normals, uniforms
from vectable.operators.halo import rows_ahead
from vectable.operators.joins import join_unique
from vectable.operators.layout import shape
from vectable.operators.mixture import Mixture, component_log_densities, fit_mixture, log_sum_exp
from vectable.operators.moments import moments
from vectable.operators.order import sequence_position
from vectable.operators.scan import entering, log_times
from vectable.session import reused

CHUNK_ROWS = 4096
CELLS = 2_000_000
EMISSIONS = ("gaussian", "discrete", "gmm", "diag_gmm")


@dataclass(frozen=True)
class Hmm:
    """Start (S), transitions (S, S) and emissions.

    discrete: one (S, symbols) table per feature; gaussian: means (S, d) and covariances
    (S, d, d); gmm and diag_gmm: one mixture per state.
    """

    kind: str
    start: np.ndarray
    trans: np.ndarray
    tables: tuple[np.ndarray, ...] = ()
    means: np.ndarray | None = None
    covs: np.ndarray | None = None
    mixtures: tuple[Mixture, ...] = ()
    loglik: float = float("nan")
    iterations: int = 0

    @property
    def states(self) -> int:
        return len(self.start)


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x)


def log_emissions(model: Hmm, x: np.ndarray) -> np.ndarray:
    """ln P(observation | state), shape (n, S)."""
    if model.kind == "discrete":
        out = np.zeros((len(x), model.states))
        for f, table in enumerate(model.tables):
            symbol = x[:, f].astype(np.int64)
            inside = (symbol >= 0) & (symbol < table.shape[1])
            row = _log(table.T)[np.clip(symbol, 0, table.shape[1] - 1)]
            out += np.where(inside[:, None], row, -np.inf)
        return out
    if model.kind == "gaussian":
        return component_log_densities(Mixture(np.full(model.states, 1.0), model.means, model.covs), x)
    return np.stack([log_sum_exp(component_log_densities(m, x) + _log(m.weights), 1) for m in model.mixtures], axis=1)


# --- chunks ---------------------------------------------------------------------------


def chunked(df: DataFrame, *, seq_col: str = "seq", time_cols: tuple[str, ...] = ("t",), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(seq, c, is_last, n, x): consecutive rows of a sequence, at most ``chunk_rows`` of them, in time order."""
    placed = sequence_position(df.select(F.col(seq_col).alias("seq"), *time_cols, "features"), ["seq"], list(time_cols), "pos")
    cells = F.array_sort(F.collect_list(F.struct("pos", "features")))
    chunks = placed.groupBy("seq", F.expr(f"pos div {chunk_rows}").alias("c")).agg(F.count("*").alias("n"), cells.alias("rows"))
    flat = F.flatten(F.transform("rows", lambda r: r["features"]))
    ends = df.groupBy(F.col(seq_col).alias("seq")).agg(F.expr(f"(count(*) - 1) div {chunk_rows}").alias("last_c"))
    tagged = join_unique(chunks, ends, "seq", counts=ends.select("seq", (F.col("last_c") + 1).alias("count")))
    return tagged.select("seq", "c", (F.col("c") == F.col("last_c")).alias("is_last"), "n", flat.alias("x"))


@dataclass
class Stack:
    """Some chunks side by side: log emissions (m, L, S), validity (m, L), and their row numbers in the batch."""

    rows: np.ndarray
    x: np.ndarray
    logb: np.ndarray
    valid: np.ndarray


def stacks(batch: pa.RecordBatch, model: Hmm) -> Iterator[Stack]:
    """Chunks of a batch, sorted by length and padded in groups of bounded size."""
    lengths = batch.column("n").to_numpy()
    values, offsets = batch.column("x").flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
    total = int(offsets[-1])
    dim = len(values) // max(total, 1)
    x = values.reshape(total, dim)
    logb = log_emissions(model, x)
    order, at = np.argsort(lengths, kind="stable"), 0
    while at < len(order):
        top = at + 1
        while top < len(order) and (top + 1 - at) * lengths[order[top]] * model.states * (model.states + dim) <= CELLS:
            top += 1
        rows = order[at:top]
        width = int(lengths[rows].max())
        valid = np.arange(width) < lengths[rows][:, None]
        take = np.minimum(offsets[rows][:, None] + np.arange(width), total - 1)
        yield Stack(rows, x[take], logb[take], valid)
        at = top


def _chunk_matrix(s: Stack, model: Hmm, best: bool) -> np.ndarray:
    """(m, S, S): the action of each chunk on the predicted-state weights that enter it."""
    size, a = model.states, _log(model.trans)
    out = np.broadcast_to(np.where(np.eye(size) > 0, 0.0, -np.inf), (len(s.rows), size, size)).copy()
    for t in range(s.logb.shape[1]):
        moved = log_times(out + s.logb[:, t][:, None, :], a[None, None], best)
        out = np.where(s.valid[:, t][:, None, None], moved, out)
    return out


def _matrices(chunks: DataFrame, model: Hmm, best: bool) -> DataFrame:
    kind = chunks.schema["seq"].dataType.simpleString()
    size = model.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty((batch.num_rows, size * size))
            for s in stacks(batch, model):
                out[s.rows] = _chunk_matrix(s, model, best).reshape(len(s.rows), -1)
            yield pa.RecordBatch.from_arrays([batch.column("seq"), batch.column("c"), from_matrix(out)], names=["seq", "c", "m"])

    return chunks.mapInArrow(run, f"seq {kind}, c bigint, m array<double>")


def _is_long(chunks: DataFrame) -> bool:
    return (chunks.agg(F.max("c")).first()[0] or 0) > 0


def _with_entry(chunks: DataFrame, model: Hmm, best: bool, long: bool) -> DataFrame:
    """Adds the log weights of the predicted state at the first row of each chunk."""
    start = _log(model.start)
    if not long:
        return chunks.withColumn("entry", F.array(*[F.lit(float(v)) for v in start]))
    return chunks.join(entering(_matrices(chunks, model, best), start, best=best), ["seq", "c"])


def _reverse(mats: DataFrame, chunks: DataFrame) -> DataFrame:
    """Count chunks from the end of each sequence."""
    last = chunks.filter("is_last").select("seq", F.col("c").alias("last_c"))
    counts = last.select("seq", (F.col("last_c") + 1).alias("count"))
    return join_unique(mats, last, "seq", counts=counts).withColumn("c", F.col("last_c") - F.col("c")).drop("last_c")


def _emit(chunks: DataFrame, model: Hmm, schema: str, fn: Callable[[pa.RecordBatch, Stack], Iterator[pa.RecordBatch]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in stacks(batch, model):
                yield from fn(batch, s)

    return chunks.mapInArrow(run, schema)


def _vectors(batch: pa.RecordBatch, name: str, rows: np.ndarray) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(batch.num_rows, -1)[rows]


# --- scoring ----------------------------------------------------------------------------


def log_likelihood(df: DataFrame, model: Hmm, *, seq_col: str = "seq", time_cols: tuple[str, ...] = ("t",), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(seq, n, loglik) by the forward recursion."""
    chunks = chunked(df, seq_col=seq_col, time_cols=time_cols, chunk_rows=chunk_rows)
    return _loglik(chunks, model, _is_long(chunks)).select(F.col("seq").alias(seq_col), "n", "loglik")


def _loglik(chunks: DataFrame, model: Hmm, long: bool) -> DataFrame:
    kind = chunks.schema["seq"].dataType.simpleString()
    a = _log(model.trans)

    def forward(batch: pa.RecordBatch, s: Stack) -> Iterator[pa.RecordBatch]:
        pred = _vectors(batch, "entry", s.rows)
        alpha = pred
        for t in range(s.logb.shape[1]):
            now = pred + s.logb[:, t]
            alpha = np.where(s.valid[:, t][:, None], now, alpha)
            pred = log_times(alpha, a[None], False)
        pick = pa.array(s.rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(k).take(pick) for k in ("seq", "c", "is_last", "n")] + [pa.array(log_sum_exp(alpha, 1))],
            names=["seq", "c", "is_last", "n", "ll"],
        )

    ends = _emit(_with_entry(chunks, model, False, long), model, f"seq {kind}, c bigint, is_last boolean, n bigint, ll double", forward)
    return ends.groupBy("seq").agg(F.sum("n").alias("n"), F.max(F.when(F.col("is_last"), F.col("ll"))).alias("loglik"))


def _viterbi_pass(s: Stack, model: Hmm, pred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best scores at each chunk's last row, and back pointers (m, L, S): entry t leads from row t+1 back to row t."""
    a = _log(model.trans)
    back = np.zeros(s.logb.shape, dtype=np.int64)
    delta = pred
    for t in range(s.logb.shape[1]):
        live = s.valid[:, t][:, None]
        delta = np.where(live, pred + s.logb[:, t], delta)
        terms = delta[:, :, None] + a[None]
        back[:, t] = terms.argmax(1)
        pred = terms.max(1)
    return delta, back


def viterbi(df: DataFrame, model: Hmm, *, seq_col: str = "seq", time_cols: tuple[str, ...] = ("t",), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(seq, pos, state): the most likely state path; pos is the 0-based place in the sequence."""
    chunks = chunked(df, seq_col=seq_col, time_cols=time_cols, chunk_rows=chunk_rows)
    long, size = _is_long(chunks), model.states
    kind = chunks.schema["seq"].dataType.simpleString()
    ready = _with_entry(chunks, model, True, long)

    def trace(s: Stack, back: np.ndarray, after: np.ndarray) -> np.ndarray:
        """States of all rows, given the state of the row after each chunk."""
        m, width = s.valid.shape
        path, state = np.zeros((m, width), dtype=np.int64), after
        for t in range(width - 1, -1, -1):
            came = back[np.arange(m), t, state]
            state = np.where(s.valid[:, t], came, state)
            path[:, t] = state
        return path

    def last_state(s: Stack, delta: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Make the step after a sequence's last row lead to its best final state."""
        ends = back.copy()
        at = s.valid.sum(1) - 1
        ends[np.arange(len(at)), at] = delta.argmax(1)[:, None]
        return ends

    if long:

        def maps(batch: pa.RecordBatch, s: Stack) -> Iterator[pa.RecordBatch]:
            delta, back = _viterbi_pass(s, model, _vectors(batch, "entry", s.rows))
            final = batch.column("is_last").to_numpy(zero_copy_only=False)[s.rows]
            back = np.where(final[:, None, None], last_state(s, delta, back), back)
            out = np.full((len(s.rows), size, size), -np.inf)
            for j in range(size):
                first = trace(s, back, np.full(len(s.rows), j))[:, 0]
                out[np.arange(len(s.rows)), j, first] = 0.0
            pick = pa.array(s.rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq").take(pick), batch.column("c").take(pick), from_matrix(out.reshape(len(s.rows), -1))], names=["seq", "c", "m"]
            )

        back_maps = _emit(ready, model, f"seq {kind}, c bigint, m array<double>", maps)
        one_hot = np.where(np.arange(size) == 0, 0.0, -np.inf)
        exits = entering(_reverse(back_maps, chunks), one_hot, best=True)
        exits = _reverse(exits, chunks).withColumnRenamed("entry", "exit")
        ready = ready.join(exits, ["seq", "c"])
    else:
        ready = ready.withColumn("exit", F.array(*[F.lit(0.0)] * size))

    def paths(batch: pa.RecordBatch, s: Stack) -> Iterator[pa.RecordBatch]:
        delta, back = _viterbi_pass(s, model, _vectors(batch, "entry", s.rows))
        final = batch.column("is_last").to_numpy(zero_copy_only=False)[s.rows]
        back = np.where(final[:, None, None], last_state(s, delta, back), back)
        path = trace(s, back, _vectors(batch, "exit", s.rows).argmax(1))
        row, col = np.nonzero(s.valid)
        pos = batch.column("c").to_numpy()[s.rows][row] * chunk_rows + col
        yield pa.RecordBatch.from_arrays(
            [batch.column("seq").take(pa.array(s.rows[row])), pa.array(pos), pa.array(path[row, col].astype(np.int32))], names=["seq", "pos", "state"]
        )

    return _emit(ready, model, f"seq {kind}, pos bigint, state int", paths).withColumnRenamed("seq", seq_col)


# --- training ---------------------------------------------------------------------------


def _expected(batch: pa.RecordBatch, s: Stack, model: Hmm) -> Partials:
    """Expected counts of one stack of chunks (forward-backward with per-step scaling)."""
    m, width, size = s.logb.shape
    top = s.logb.max(2, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    b = np.exp(s.logb - top)
    entry = _vectors(batch, "entry", s.rows)
    shift = entry.max(1, keepdims=True)
    pred = np.exp(entry - shift)
    alpha, loglik = np.zeros((m, width, size)), np.zeros(m)
    for t in range(width):
        now = pred * b[:, t]
        scale = np.maximum(now.sum(1), 1e-300)
        live = s.valid[:, t]
        alpha[:, t] = now / scale[:, None]
        loglik += np.where(live, np.log(scale) + top[:, t, 0], 0.0)
        pred = np.where(live[:, None], alpha[:, t] @ model.trans, pred)
    final = batch.column("is_last").to_numpy(zero_copy_only=False)[s.rows]
    loglik = np.where(final, loglik + shift[:, 0], 0.0)
    after = _vectors(batch, "exit", s.rows)
    ahead = np.where(final[:, None], 1.0, np.exp(after - after.max(1, keepdims=True)))
    gamma = np.zeros((m, width, size))
    pairs = np.zeros((size, size))
    lengths = s.valid.sum(1)
    for t in range(width - 1, -1, -1):
        live = s.valid[:, t]
        ends = final & (lengths - 1 == t)
        beta = np.where(ends[:, None], 1.0, ahead @ model.trans.T)
        g = alpha[:, t] * beta
        gamma[:, t] = np.where(live[:, None], g / np.maximum(g.sum(1, keepdims=True), 1e-300), 0.0)
        step = live & ~ends
        xi = alpha[step, t][:, :, None] * model.trans[None] * ahead[step][:, None, :]
        pairs += (xi / np.maximum(xi.sum((1, 2), keepdims=True), 1e-300)).sum(0)
        here = b[:, t] * beta
        ahead = np.where(live[:, None], here / np.maximum(here.sum(1, keepdims=True), 1e-300), ahead)
    first = batch.column("c").to_numpy()[s.rows] == 0
    flat, x = gamma[s.valid], s.x[s.valid]
    out = {"start": gamma[first, 0].sum(0), "pairs": pairs, "ll": np.array(loglik.sum()), "g": flat.sum(0)}
    if model.kind == "gaussian":
        z = x - model_shift(model)
        out["s"] = flat.T @ z
        out["q"] = np.stack([(z * flat[:, [k]]).T @ z for k in range(size)])
    else:
        for f, table in enumerate(model.tables):
            counts = np.zeros(table.shape)
            np.add.at(counts.T, x[:, f].astype(np.int64), flat)
            out[f"e{f}"] = counts
    return out


def model_shift(model: Hmm) -> np.ndarray:
    """A common centre for the second moments of the emissions."""
    return model.means.mean(0)


def _rows_to_one(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(-1, keepdims=True)
    return np.where(total > 0, counts / np.where(total > 0, total, 1.0), 1.0 / counts.shape[-1])


def _maximise(model: Hmm, t: Partials) -> Hmm:
    start, trans = _rows_to_one(t["start"][None])[0], _rows_to_one(t["pairs"])
    if model.kind == "discrete":
        tables = tuple(_rows_to_one(t[f"e{f}"]) for f in range(len(model.tables)))
        return replace(model, start=start, trans=trans, tables=tables)
    g = np.maximum(t["g"], 1e-300)
    mu = t["s"] / g[:, None]
    cov = t["q"] / g[:, None, None] - mu[:, :, None] * mu[:, None, :]
    return replace(model, start=start, trans=trans, means=mu + model_shift(model), covs=np.stack([_definite(c) for c in cov]))


def _definite(cov: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh((cov + cov.T) / 2.0)
    floor = max(values.max() * 1e-8, 1e-8)
    return (vectors * np.maximum(values, floor)) @ vectors.T


def alphabet(df: DataFrame) -> DataFrame:
    """(feature_idx, symbols): largest symbol + 1 per feature over all sequences."""
    return df.select(F.posexplode("features").alias("feature_idx", "v")).groupBy("feature_idx").agg(
        (F.max("v") + 1).cast("bigint").alias("symbols")
    )


def _random_start(df: DataFrame, states: int, kind: str, seed: int) -> Hmm:
    rng = np.random.default_rng(seed)
    start, trans = _rows_to_one(rng.random((1, states)))[0], _rows_to_one(rng.random((states, states)))
    if kind == "discrete":
        sizes = [r["symbols"] for r in alphabet(df).orderBy("feature_idx").collect()]
        return Hmm(kind, start, trans, tables=tuple(_rows_to_one(rng.random((states, a))) for a in sizes))
    m = moments(df)
    spread = np.maximum(m.std_pop, 1e-4)
    means = m.mean + rng.standard_normal((states, len(m.mean))) * spread
    return Hmm(kind, start, trans, means=means, covs=np.stack([np.diag(spread**2)] * states))


def fit_hmm(
    df: DataFrame,
    states: int = 10,
    *,
    kind: str = "gaussian",
    tolerance: float = 1e-5,
    max_iterations: int = 1000,
    seq_col: str = "seq",
    time_cols: tuple[str, ...] = ("t",),
    chunk_rows: int = CHUNK_ROWS,
    seed: int = 0,
    start: Hmm | None = None,
) -> Hmm:
    """Baum-Welch until the log-likelihood changes by less than ``tolerance``."""
    if kind not in EMISSIONS:
        raise ValueError(f"kind is one of {EMISSIONS}")
    if kind in ("gmm", "diag_gmm"):
        raise ValueError("mixture emissions need labelled training")
    model = start or _random_start(df, states, kind, seed)
    last, done = -np.inf, 0
    with reused(chunked(df, seq_col=seq_col, time_cols=time_cols, chunk_rows=chunk_rows), "seq", "c", "is_last", "n", "x") as chunks:
        long = _is_long(chunks)
        while done < max_iterations:
            totals = _expectation(chunks, model, long)
            done += 1
            loglik = totals["ll"].item()
            model = replace(model, loglik=loglik, iterations=done)
            if abs(loglik - last) < tolerance:
                break
            last, model = loglik, replace(_maximise(model, totals), loglik=loglik, iterations=done)
    return model


def _expectation(chunks: DataFrame, model: Hmm, long: bool) -> Partials:
    size = model.states
    if long:
        mats = _matrices(chunks, model, False)
        ready = chunks.join(entering(mats, _log(model.start)), ["seq", "c"])
        turned = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.get("m", i * size + j))))
        back = entering(_reverse(mats.withColumn("m", turned), chunks), np.zeros(size))
        ready = ready.join(_reverse(back, chunks).withColumnRenamed("entry", "exit"), ["seq", "c"])
    else:
        ready = _with_entry(chunks, model, False, False).withColumn("exit", F.array(*[F.lit(0.0)] * size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Partials = {}
        for batch in batches:
            for s in stacks(batch, model):
                for name, part in _expected(batch, s, model).items():
                    totals[name] = totals[name] + part if name in totals else part
        if totals:
            yield partial_rows(totals)

    out = add_partials(ready.mapInArrow(run, PARTIAL_SCHEMA))
    shapes = {"start": (size,), "pairs": (size, size), "ll": (), "g": (size,)}
    if model.kind == "gaussian":
        d = model.means.shape[1]
        shapes |= {"s": (size, d), "q": (size, d, d)}
    shapes |= {f"e{f}": t.shape for f, t in enumerate(model.tables)}
    return {n: out[n].reshape(sh) if n in out else np.zeros(sh) for n, sh in shapes.items()}


# --- labelled training --------------------------------------------------------------------


def transition_counts(df: DataFrame, *, seq_col: str = "seq", time_cols: tuple[str, ...] = ("t",), state_col: str = "state") -> DataFrame:
    """(state, next_state, n) over consecutive rows of each sequence; the next state is read in place."""
    states = df.select(F.col(seq_col).alias("seq"), *time_cols, F.col(state_col).alias("state"))
    pairs = rows_ahead(states, ["seq"], list(time_cols), ["state"])
    return pairs.groupBy("state", F.col("state_ahead").alias("next_state")).agg(F.count("*").alias("n"))


def start_counts(df: DataFrame, *, seq_col: str = "seq", time_cols: tuple[str, ...] = ("t",), state_col: str = "state") -> DataFrame:
    """(state, n) of the first row of each sequence."""
    first = df.groupBy(seq_col).agg(F.min_by(state_col, F.struct(*time_cols)).alias("state"))
    return first.groupBy("state").agg(F.count("*").alias("n"))


def fit_hmm_labelled(
    df: DataFrame,
    states: int,
    *,
    kind: str = "gaussian",
    gaussians: int = 10,
    state_col: str = "state",
    seq_col: str = "seq",
    time_cols: tuple[str, ...] = ("t",),
    id_col: str | None = None,
    max_iterations: int = 250,
) -> Hmm:
    """Parameters counted from given states; labels must be 0 .. states-1 and present on every row."""
    if kind not in EMISSIONS:
        raise ValueError(f"kind is one of {EMISSIONS}")
    bad = df.filter(F.col(state_col).isNull() | (F.col(state_col) < 0) | (F.col(state_col) >= states)).limit(1).count()
    if bad:
        raise ValueError("a state label is missing or outside 0 .. states-1")
    start, pairs = np.zeros(states), np.zeros((states, states))
    keys = {"seq_col": seq_col, "time_cols": time_cols, "state_col": state_col}
    for r in start_counts(df, **keys).collect():
        start[r["state"]] = r["n"]
    for r in transition_counts(df, **keys).collect():
        pairs[r["state"], r["next_state"]] = r["n"]
    base = Hmm(kind, _rows_to_one(start[None])[0], _rows_to_one(pairs))
    if kind == "discrete":
        sizes = [r["symbols"] for r in alphabet(df).orderBy("feature_idx").collect()]
        tables = [np.zeros((states, a)) for a in sizes]
        for r in emission_counts(df, state_col).collect():
            tables[r["feature_idx"]][r["state"], r["symbol"]] = r["n"]
        return replace(base, tables=tuple(_rows_to_one(t) for t in tables))
    if kind == "gaussian":
        _, d = shape(df)
        centre = moments(df).mean

        def step(x: np.ndarray, s: np.ndarray) -> Partials:
            z, one = x - centre, np.eye(states)[s.astype(int)]
            return {"n": one.sum(0), "s": one.T @ z, "q": np.stack([(z * one[:, [k]]).T @ z for k in range(states)])}

        t = sum_over_rows(df, ["features", state_col], step)
        n = np.maximum(t["n"], 1e-300)
        mu = t["s"] / n[:, None]
        cov = t["q"] / n[:, None, None] - mu[:, :, None] * mu[:, None, :]
        return replace(base, means=mu + centre, covs=np.stack([_definite(c) for c in cov]))
    if id_col is None:
        raise ValueError("mixture emissions need id_col for their seeded starts")
    fitted = [
        fit_mixture(
            df.filter(F.col(state_col) == s), gaussians, diagonal_covariance=kind == "diag_gmm", id_col=id_col,
            max_iterations=max_iterations, kmeans_max_iterations=max_iterations, seed=s,
        )
        for s in range(states)
    ]
    return replace(base, mixtures=tuple(fitted))


def emission_counts(df: DataFrame, state_col: str = "state") -> DataFrame:
    """(state, feature_idx, symbol, n)."""
    cells = df.select(F.col(state_col).alias("state"), F.posexplode("features").alias("feature_idx", "v"))
    return cells.groupBy("state", "feature_idx", F.col("v").cast("int").alias("symbol")).agg(F.count("*").alias("n"))


# --- generation -----------------------------------------------------------------------------


def _pick(weights: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Index drawn from each row of weights."""
    return np.minimum((np.cumsum(weights, axis=1) <= u[:, None]).sum(1), weights.shape[1] - 1)


#: The draws of a step: its state, the component of a mixture; symbols and features take the draws 0, 1, ..
STATE, COMPONENT = 2_000_000, 1_000_000


def generate_states(spark: SparkSession, model: Hmm, length: int, chains: int = 1, *, start_state: int | None = None, seed: int = 0) -> DataFrame:
    """(seq, t, state): chains advance side by side in the tasks that hold their ids, each step drawn from (seed, seq, t)."""
    start, trans = model.start, model.trans
    first = None if start_state is None else min(max(int(start_state), 0), model.states - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chain = batch.column(0).to_numpy()
            if len(chain) == 0:
                continue
            state = np.full(len(chain), first) if first is not None else _pick(np.tile(start, (len(chain), 1)), uniforms(seed, STATE, chain, np.zeros_like(chain)))
            for t in range(length):
                if t:
                    state = _pick(trans[state], uniforms(seed, STATE, chain, np.full_like(chain, t)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(chain), t)), pa.array(state.astype(np.int32))], names=["seq", "t", "state"]
                )

    return spark.range(chains).mapInArrow(run, "seq bigint, t bigint, state int")


def generate(spark: SparkSession, model: Hmm, length: int, chains: int = 1, *, start_state: int | None = None, seed: int = 0) -> DataFrame:
    """(seq, t, state, features): states, then one observation each, drawn from (seed, seq, t)."""
    states = generate_states(spark, model, length, chains, start_state=start_state, seed=seed)
    if model.kind == "discrete":
        tables = model.tables

        def observe(s: np.ndarray, seq: np.ndarray, t: np.ndarray) -> np.ndarray:
            return np.stack([_pick(table[s], uniforms(seed, f, seq, t)) for f, table in enumerate(tables)], axis=1).astype(float)

    else:
        if model.kind == "gaussian":
            mixes: tuple[Mixture, ...] = tuple(Mixture(np.ones(1), model.means[[s]], model.covs[[s]]) for s in range(model.states))
        else:
            mixes = model.mixtures
        d = mixes[0].means.shape[1]
        roots = [np.stack([np.diag(np.sqrt(c)) if m.diagonal else np.linalg.cholesky(c) for c in m.covs]) for m in mixes]

        def observe(s: np.ndarray, seq: np.ndarray, t: np.ndarray) -> np.ndarray:
            out, u = np.empty((len(s), d)), uniforms(seed, COMPONENT, seq, t)
            z = np.stack([normals(seed, j, seq, t) for j in range(d)], 1)
            for k, m in enumerate(mixes):
                mine = np.flatnonzero(s == k)
                c = _pick(np.tile(m.weights, (len(mine), 1)), u[mine])
                out[mine] = m.means[c] + np.einsum("nij,nj->ni", roots[k][c], z[mine])
            return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seq, t, s = (c.to_numpy() for c in batch.columns)
                yield pa.RecordBatch.from_arrays([*batch.columns, from_matrix(observe(s, seq, t))], ["seq", "t", "state", "features"])

    return states.mapInArrow(run, "seq bigint, t bigint, state int, features array<double>")
