"""Moving feature arrays between Arrow and numpy, and summing per-partition partials."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """list<double> column to an (n, d) float64 matrix; NULL or ragged rows are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty((0, 0))
    if column.null_count:
        raise ValueError("NULL feature vector")
    values = column.flatten()
    if values.null_count:
        raise ValueError("NULL feature value")
    if len(values) % n or np.any(np.diff(column.offsets.to_numpy()) * n != len(values)):
        raise ValueError("feature vectors differ in length")
    return values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1)


def from_matrix(matrix: np.ndarray) -> pa.ListArray:
    """(n, d) matrix to a list<double> column."""
    n, d = matrix.shape
    flat = pa.array(np.ascontiguousarray(matrix, dtype=np.float64).reshape(-1))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), flat)


def column_values(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Matrix for list columns, vector for scalar columns."""
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        return to_matrix(column)
    return column.to_numpy(zero_copy_only=False)


def matrix_udf(fn: Callable[[np.ndarray], np.ndarray], returns: str = "array<double>") -> Callable[..., Column]:
    """Arrow-batched column function from a numpy one; works on batch and streaming frames."""

    @F.arrow_udf(returns)
    def wrapped(x: pa.Array) -> pa.Array:
        out = np.asarray(fn(column_values(x)))
        if out.ndim == 2:
            return from_matrix(out)
        return pa.array(out.astype(np.int32) if returns == "int" else out)

    return wrapped


Partials = dict[str, np.ndarray]


Batch = tuple[np.ndarray, ...]


WIDE = 32
PARTIAL_SCHEMA = "name string, shape array<bigint>, piece int, " + ", ".join(f"c{i} double" for i in range(WIDE))


def partial_rows(totals: Partials) -> pa.RecordBatch:
    """Named arrays as rows of WIDE numbers, padded with zeros."""
    names, shapes, pieces, blocks = [], [], [], []
    for name, value in totals.items():
        flat = np.asarray(value, dtype=np.float64).reshape(-1)
        n = -(-len(flat) // WIDE)
        names += [name] * n
        shapes += [list(np.shape(value))] * n
        pieces.append(np.arange(n, dtype=np.int32))
        blocks.append(np.pad(flat, (0, n * WIDE - len(flat))).reshape(n, WIDE))
    cells = np.concatenate(blocks) if blocks else np.empty((0, WIDE))
    columns = [pa.array(names, pa.string()), pa.array(shapes, pa.list_(pa.int64())), pa.array(np.concatenate([*pieces, np.empty(0, np.int32)]), pa.int32())]
    return pa.RecordBatch.from_arrays(columns + [pa.array(np.ascontiguousarray(cells[:, i])) for i in range(WIDE)], ["name", "shape", "piece", *[f"c{i}" for i in range(WIDE)]])


def add_partials(partial: DataFrame) -> Partials:
    """The sum of the arrays of each name: a Spark aggregation whose rows hold WIDE numbers."""
    got = partial.groupBy("name", "shape", "piece").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(WIDE)]).toArrow()
    names, shapes, piece = np.array(got["name"].to_pylist(), dtype=object), got["shape"].to_pylist(), got["piece"].to_numpy()
    cells = np.stack([got[f"c{i}"].to_numpy() for i in range(WIDE)], 1)
    out: Partials = {}
    for name in set(names.tolist()):
        at = np.flatnonzero(names == name)
        shape = shapes[at[0]]
        out[name] = cells[at[np.argsort(piece[at])]].reshape(-1)[: int(np.prod(shape)) if shape else 1].reshape(shape)
    return out


#: Rows of a packed block.
PACKED_ROWS = 1 << 15


@dataclass(frozen=True)
class Packed:
    """Columns of a table as kept blocks of rows, each column of a block the bytes of one array: a pass copies bytes and converts no rows."""

    blocks: DataFrame
    columns: int


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[Batch] = []

    def block() -> pa.RecordBatch:
        fields: list[pa.Array] = []
        for parts in zip(*held):
            whole = np.concatenate(parts)
            whole = whole.astype(np.float64) if whole.dtype == object else whole
            shape = pa.array([list(whole.shape)], pa.list_(pa.int64()))
            fields += [pa.array([whole.dtype.str]), shape, pa.array([np.ascontiguousarray(whole).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(fields, [f"{n}{i}" for i in range(len(fields) // 3) for n in ("kind", "shape", "bytes")])

    for batch in batches:
        if batch.num_rows:
            held.append(tuple(column_values(c) for c in batch.columns))
            if sum(len(h[0]) for h in held) >= PACKED_ROWS:
                yield block()
                held = []
    if held:
        yield block()


def unpacked(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[Batch]:
    """The arrays of each kept block."""
    for batch in batches:
        for r in range(batch.num_rows):
            at = [[batch.column(3 * i + k)[r] for k in range(3)] for i in range(columns)]
            yield tuple(np.frombuffer(b.as_buffer(), kind.as_py()).reshape(shape.as_py()) for kind, shape, b in at)


@contextmanager
def packed(df: DataFrame, columns: list[str | Column]) -> Iterator[Packed]:
    """The columns, packed for the passes of an iterative job and released afterwards; few partitions are spread over the cores."""
    picked = df.select(*[c if isinstance(c, Column) else F.col(c) for c in columns])
    cores = df.sparkSession.sparkContext.defaultParallelism
    picked = picked.repartition(cores) if picked.rdd.getNumPartitions() < cores else picked
    schema = ", ".join(f"kind{i} string, shape{i} array<bigint>, bytes{i} binary" for i in range(len(columns)))
    blocks = picked.mapInArrow(_pack, schema).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Packed(blocks, len(columns))
    finally:
        blocks.unpersist()


def sum_over_tasks(
    df: DataFrame | Packed,
    columns: list[str | Column],
    task: Callable[[Iterator[Batch]], Partials],
) -> Partials:
    """Sum named arrays over tasks: one scan, one small shuffle.

    ``task`` sees the Arrow batches of one partition (one numpy array per column) and
    returns arrays whose shapes do not depend on the data.  The cross-task sum is a
    Spark aggregation, so only model-sized rows reach the driver.
    """
    known = df.columns if isinstance(df, Packed) else None
    picked = df.blocks if isinstance(df, Packed) else df.select(*[c if isinstance(c, Column) else F.col(c) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = (b for b in batches if b.num_rows)
        totals = task((tuple(column_values(c) for c in b.columns) for b in full) if known is None else unpacked(full, known))
        if totals:
            yield partial_rows(totals)

    return add_partials(picked.mapInArrow(run, PARTIAL_SCHEMA))


def sum_over_rows(df: DataFrame, columns: list[str | Column], step: Callable[..., Partials]) -> Partials:
    """The same for sums over rows: ``step`` turns one batch into arrays, which are added up."""

    def task(batches: Iterator[Batch]) -> Partials:
        totals: Partials = {}
        for batch in batches:
            for name, value in step(*batch).items():
                totals[name] = totals[name] + value if name in totals else np.asarray(value, dtype=np.float64)
        return totals

    return sum_over_tasks(df, columns, task)


def sq_dists(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, exact differences for few dimensions, products otherwise."""
    if a.shape[1] <= 4:
        out = np.zeros((len(a), len(b)))
        for j in range(a.shape[1]):
            diff = a[:, j, None] - b[None, :, j]
            out += diff * diff
        return out
    out = a @ b.T
    out *= -2.0
    out += (a * a).sum(1)[:, None]
    out += (b * b).sum(1)[None, :]
    return np.maximum(out, 0.0, out=out)


def row_slices(n: int, width: int, cells: int = 4_000_000) -> Iterator[slice]:
    """Slices of n rows so that rows x width stays below a cell budget."""
    step = max(1, cells // max(1, width))
    for lo in range(0, n, step):
        yield slice(lo, min(n, lo + step))


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and exact squared distance of the nearest center; the first one wins ties."""
    idx = np.empty(len(x), dtype=np.int64)
    dist = np.empty(len(x))
    for s in row_slices(len(x), len(centers)):
        d = sq_dists(x[s], centers)
        best = d.argmin(1)
        # Copies of a center can differ in the last bits of the product form.
        tol = 1e-9 * (1.0 + (x[s] * x[s]).sum(1))
        close = d <= (d[np.arange(len(best)), best] + tol)[:, None]
        for r in np.flatnonzero(close.sum(1) > 1):
            cand = np.flatnonzero(close[r])
            exact = ((centers[cand] - x[s][r]) ** 2).sum(1)
            best[r] = cand[exact.argmin()]
        idx[s] = best
        dist[s] = ((x[s] - centers[best]) ** 2).sum(1)
    return idx, dist
