"""Independent components by direct entropy estimates over rotation angles."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.functions.blocks import Packed, matrix_udf, packed, row_slices, to_matrix, unpacked
from vectable.functions.hashing import normals
from vectable.operators.halo import root_ahead
from vectable.operators.moments import covariance
from vectable.operators.order import sample_rows
from vectable.session import cut_lineage, reused

# Smallest positive normal double: spacing of tied values.
TINY = 2.2250738585072014e-308
#: Replicas of a table that a single task makes for itself (256 MB a component, three of which it holds).
LOCAL_VALUES = 32_000_000
#: Values that are turned, or whose logarithms are taken, at a time.
SLICE = 1 << 16
#: Beyond that: angles whose replicas are exchanged at a time at most, values that are (8 bytes each), values that a task sorts, and points that tell where to cut.
ANGLES_AT_ONCE, EXCHANGED_VALUES, SLICE_VALUES, CUT_POINTS = 10, 160_000_000, 4_000_000, 4000


def spacing_entropy(df: DataFrame, value_col: str, tie_cols: list[str], group_col: str) -> DataFrame:
    """(group, n, entropy): Vasicek m-spacing estimate, sum of ln(z[i+m] - z[i]) over sorted values, m = floor(sqrt(n)).

    Values are range-partitioned by (group, value) and kept as one sorted array for each group of a partition. Spacings
    are read in place but for the edges of arrays, of which a group's meet: no task holds a whole group.  A spacing from or to NULL counts as the smallest one.
    """
    picked = df.select(F.col(group_col).alias("g"), F.col(value_col).cast("double").alias("z"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_cols)])
    placed = picked.repartitionByRange("g", "z", *[f"t{i}" for i in range(len(tie_cols))]).select("g", "z", F.spark_partition_id().alias("pid"))
    group = T.StructField("g", picked.schema["g"].dataType)
    packs = T.StructType([group, *[T.StructField(n, T.LongType()) for n in ("pid", "rows", "nulls")], T.StructField("z", T.BinaryType())])
    # Range boundaries are sampled, so the placement is fixed here.
    fixed = cut_lineage(placed.mapInArrow(_packed_runs, packs))
    by_run = W.partitionBy("g").orderBy("pid")
    sizes = fixed.select("g", "pid", "rows")
    ranked = sizes.select("g", "pid", F.sum("rows").over(W.partitionBy("g")).alias("n"), (F.sum("rows").over(by_run) - F.col("rows")).alias("rank"))
    runs = fixed.alias("f").join(ranked.alias("r"), F.col("f.pid").eqNullSafe(F.col("r.pid")) & F.col("f.g").eqNullSafe(F.col("r.g")))
    runs = runs.select("f.g", "r.n", "r.rank", "f.rows", "f.nulls", "f.z")
    edges = T.StructType([group, *[T.StructField(n, T.LongType()) for n in ("n", "rank", "nulls")], T.StructField("z", T.BinaryType()), T.StructField("ask", T.BooleanType()), T.StructField("entropy", T.DoubleType())])
    sums = T.StructType([group, T.StructField("n", T.LongType()), T.StructField("entropy", T.DoubleType())])
    # Kept, since sums and edges both come from one pass over the arrays.
    near = cut_lineage(runs.mapInArrow(_run_sums, edges))
    far = near.where("ask IS NOT NULL").groupBy("g").applyInArrow(_edge_sums, sums)
    both = near.where("ask IS NULL").select("g", "n", "entropy").unionByName(far)
    return both.groupBy("g").agg(F.first("n").alias("n"), F.sum("entropy").alias("entropy")).where("n > 1").withColumnRenamed("g", group_col)


def _packed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, pid, rows, nulls, sorted values that are not NULL) for each group of a partition (g, z, pid)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    coded = table["g"].combine_chunks().dictionary_encode("encode")
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    code, null = coded.indices.to_numpy(), table["z"].is_null().to_numpy()
    z, pid = table["z"].to_numpy(), table["pid"][0].as_py()
    groups = len(coded.dictionary)
    if groups > 1:
        order = np.argsort(code, kind="stable")
        z, null = z[order], null[order]
    ends = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=groups))))
    for k in range(groups):
        at = slice(ends[k], ends[k + 1])
        values = np.sort(z[at][~null[at]])
        columns = [[pid], [at.stop - at.start], [at.stop - at.start - len(values)]]
        yield pa.RecordBatch.from_arrays(
            [coded.dictionary.slice(k, 1), *[pa.array(np.array(c, np.int64)) for c in columns], pa.array([values.tobytes()], pa.binary())], ["g", "pid", "rows", "nulls", "z"]
        )


def _run_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every array its summed entropy, the values whose partner lies further on, and those that may be partners."""
    for batch in batches:
        for i in range(batch.num_rows):
            n, rank, rows, nulls = (int(batch.column(k)[i].as_py()) for k in range(1, 5))
            z, m = np.frombuffer(batch.column(5)[i].as_buffer(), float), int(root_ahead(np.array([n]))[0])
            low = max(0, min(nulls, rows - m))
            out = [(0, 0, b"", None, low * math.log(TINY) + sorted_entropy(z, m))]
            asks, answers = (max(0, rows - m), min(rows, n - m - rank)), (0, min(rows, m))
            for (lo, hi), ask in ((asks, True), (answers, False)):
                if lo < hi and rows < n:
                    out.append((rank + lo, max(0, min(hi, nulls) - lo), z[max(0, lo - nulls) : max(0, hi - nulls)].tobytes(), ask, None))
            where, empty, kept, ask, entropy = zip(*out)
            g = pa.concat_arrays([batch.column(0).slice(i, 1)] * len(out))
            numbers = [pa.array(np.array(c, np.int64)) for c in ([n] * len(out), where, empty)]
            yield pa.RecordBatch.from_arrays([g, *numbers, pa.array(kept, pa.binary()), pa.array(ask, pa.bool_()), pa.array(entropy, pa.float64())], ["g", "n", "rank", "nulls", "z", "ask", "entropy"])


def _edge_sums(group: pa.Table) -> pa.Table:
    """The summed entropy of the values of a group whose partner, m ranks further on, lies in another array."""
    n, m = group["n"][0].as_py(), int(root_ahead(np.array([group["n"][0].as_py()]))[0])

    def ranked(side: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [(r["rank"], r["nulls"], np.frombuffer(r["z"], float)) for r in side.select(["rank", "nulls", "z"]).to_pylist()]
        parts.sort(key=lambda p: p[0])
        rank = [np.arange(a, a + k + len(z)) for a, k, z in parts]
        null = [np.arange(k + len(z)) < k for _, k, z in parts]
        value = [np.concatenate((np.zeros(k), z)) for _, k, z in parts]
        return tuple(np.concatenate([np.empty(0, t), *v]) for v, t in ((rank, np.int64), (null, bool), (value, float)))

    rank, null, z = ranked(group.filter(group["ask"]))
    there, null_there, z_there = ranked(group.filter(pc.invert(group["ask"])))
    at = np.searchsorted(there, rank + m)
    gap = np.where(null | null_there[at], TINY, np.maximum(z_there[at] - z, TINY))
    return pa.table([group["g"].slice(0, 1), pa.array([n], pa.int64()), pa.array([float(np.log(gap).sum())])], ["g", "n", "entropy"])


@dataclass(frozen=True)
class Unmixing:
    """Y = W x; ``objective`` is the summed entropy estimate of the components of Y."""

    w: np.ndarray
    objective: float


def _rotation(d: int, i: int, j: int, theta: float) -> np.ndarray:
    r = np.eye(d)
    r[i, i] = r[j, j] = math.cos(theta)
    r[i, j], r[j, i] = -math.sin(theta), math.sin(theta)
    return r


def _turned(a: np.ndarray, b: np.ndarray, theta: float) -> tuple[np.ndarray, np.ndarray]:
    return math.cos(theta) * a - math.sin(theta) * b, math.sin(theta) * a + math.cos(theta) * b


def _replicas(ids: np.ndarray, a: np.ndarray, b: np.ndarray, std_dev: float, replicates: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Every point ``replicates`` times, each with normal noise of its own."""
    sides = np.empty((2, replicates * len(ids)))
    for side, x in enumerate((a, b)):
        for k in range(replicates):
            for s in row_slices(len(ids), 1, SLICE):
                noise = std_dev * normals(seed, side, ids[s], np.full_like(ids[s], k)) if std_dev else 0.0
                sides[side, k * len(ids) + s.start : k * len(ids) + s.stop] = x[s] + noise
    return sides[0], sides[1]


EXPONENT, MANTISSA, ONE = 52, (1 << 52) - 1, 1023 << 52


def log_sum(x: np.ndarray) -> float:
    """Sum of the logarithms of positive normal numbers: exponents are added, mantissas multiplied by 32, one logarithm for each product."""
    bits = np.ascontiguousarray(x, float).view(np.int64)
    whole = len(x) // 32 * 32
    mantissa = ((bits & MANTISSA) | ONE).view(float)
    products = np.multiply.reduce(mantissa[:whole].reshape(32, -1), axis=0)
    return float((bits >> EXPONENT).sum() - 1023 * len(x)) * math.log(2.0) + float(np.log(products).sum() + np.log(mantissa[whole:]).sum())


def sorted_entropy(z: np.ndarray, m: int) -> float:
    """The m-spacing estimate of sorted values."""
    if not len(z) or m >= len(z):
        return 0.0
    if not np.isfinite(z[[0, -1]]).all():
        return float(np.log(np.maximum(z[m:] - z[:-m], TINY)).sum())
    return math.fsum(log_sum(np.maximum(z[s.start + m : s.stop + m] - z[s], TINY)) for s in row_slices(len(z) - m, 1, SLICE))


def _angle_entropy(a: np.ndarray, b: np.ndarray, theta: float, z: np.ndarray) -> float:
    """The summed estimate of both components turned by an angle; ``z`` is room for one of them."""
    m, total = int(root_ahead(np.array([len(z)]))[0]), 0.0
    for c, s in ((math.cos(theta), -math.sin(theta)), (math.sin(theta), math.cos(theta))):
        for part in row_slices(len(z), 1, SLICE):
            z[part] = c * a[part] + s * b[part]
        z.sort()
        total += sorted_entropy(z, m)
    return total


def _cuts(pair: DataFrame, thetas: list[float], slices: int, std_dev: float, replicates: int, seed: int) -> list[np.ndarray]:
    """Where the values of each side of each angle are cut into slices of about one size, read off a drawn part of the points."""
    if slices < 2:
        return [np.empty(0)] * (2 * len(thetas))
    got = sample_rows(pair, CUT_POINTS, "_id", seed).toArrow()
    x, at = to_matrix(got["ab"]), np.arange(1, slices) / slices
    a, b = _replicas(got["_id"].to_numpy(), x[:, 0], x[:, 1], std_dev, replicates, seed)
    return [np.unique(np.quantile(z, at)) for theta in thetas for z in _turned(a, b, theta)]


def _rounds(sides: int, slices: int, values: int) -> Iterator[list[tuple[int, int, int]]]:
    """(side, first slice, end) of all slices of all sides, no more of them at a time than EXCHANGED_VALUES; a side has so many values."""
    room = max(1, EXCHANGED_VALUES * slices // max(1, values))
    each = max(1, min(room // slices, 2 * ANGLES_AT_ONCE))
    parts = [(g, lo, min(slices, lo + room)) for g in range(sides) for lo in range(0, slices, min(room, slices))]
    for i in range(0, len(parts), each):
        yield parts[i : i + each]


def _exchange(blocks: Packed, parts: list[tuple[int, int, int]], thetas: list[float], cuts: list[np.ndarray], m: int, std_dev: float, replicates: int, seed: int) -> list[dict]:
    """(g, slice, rows, entropy, head, tail) of the slices: the summed entropy within each, and its first and last m values."""
    columns = blocks.columns

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in unpacked(batches, columns):
            for s in row_slices(len(x), replicates * 8):
                a, b = _replicas(ids[s], x[s, 0], x[s, 1], std_dev, replicates, seed)
                for g, lo, hi in parts:
                    z = _turned(a, b, thetas[g // 2])[g % 2]
                    z.sort()
                    ends = [0, *np.searchsorted(z, cuts[g]), len(z)]
                    some = [(i, z[ends[i] : ends[i + 1]]) for i in range(lo, min(hi, len(ends) - 1)) if ends[i] < ends[i + 1]]
                    if some:
                        which, kept = zip(*some)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), g)), pa.array(which, pa.int64()), pa.array([k.tobytes() for k in kept], pa.binary())], ["g", "slice", "z"])

    def joined(group: pa.Table) -> pa.Table:
        z = np.concatenate([np.frombuffer(v.as_buffer(), float) for v in group["z"]])
        z.sort()
        edges = [pa.array([e.tobytes()], pa.binary()) for e in (z[:m], z[max(0, len(z) - m) :])]
        return pa.table([group["g"].slice(0, 1), group["slice"].slice(0, 1), pa.array([len(z)], pa.int64()), pa.array([sorted_entropy(z, m)]), *edges], ["g", "slice", "rows", "entropy", "head", "tail"])

    pieces = blocks.blocks.mapInArrow(turn, "g bigint, slice bigint, z binary")
    return pieces.groupBy("g", "slice").applyInArrow(joined, "g bigint, slice bigint, rows bigint, entropy double, head binary, tail binary").toArrow().to_pylist()


def _side_entropy(slices: list[dict], m: int) -> float:
    """The summed entropy of a side from its slices: that within them, and that of values whose partner, m ranks further on, lies in a later slice."""
    slices = sorted(slices, key=lambda r: r["slice"])
    end = np.cumsum([r["rows"] for r in slices])
    heads, tails = ([np.frombuffer(r[k], float) for r in slices] for k in ("head", "tail"))
    there = np.concatenate([e - r["rows"] + np.arange(len(h)) for e, r, h in zip(end, slices, heads)])
    rank = np.concatenate([e - len(t) + np.arange(len(t)) for e, t in zip(end, tails)])
    asks = rank + m < end[-1]
    z, partner = np.concatenate(tails)[asks], np.concatenate(heads)[np.searchsorted(there, rank[asks] + m)]
    return math.fsum([*[r["entropy"] for r in slices], float(np.log(np.maximum(partner - z, TINY)).sum())])


def _by_slices(pair: DataFrame, points: int, thetas: list[float], std_dev: float, replicates: int, seed: int) -> list[float]:
    """The scores of a table whose replicas no task can hold: slices of their values are exchanged as arrays, a bounded number at a time."""
    values = points * replicates
    m, slices = int(root_ahead(np.array([values]))[0]), max(1, -(-values // SLICE_VALUES))
    cuts = _cuts(pair, thetas, slices, std_dev, replicates, seed)
    held: dict[int, list[dict]] = {g: [] for g in range(2 * len(thetas))}
    score = [0.0] * len(thetas)
    context = pair.sparkSession.sparkContext
    with packed(pair, ["_id", "ab"]) as blocks:
        for parts in _rounds(2 * len(thetas), slices, values):
            for r in _exchange(blocks, parts, thetas, cuts, m, std_dev, replicates, seed):
                held[r["g"]].append(r)
            for g, _, hi in parts:
                if hi == slices:
                    done = held.pop(g)
                    score[g // 2] += _side_entropy(done, m) if values > 1 and done else 0.0
            if values * len(thetas) > EXCHANGED_VALUES:
                # Spark removes the files of an exchange when the driver has collected what refers to it.
                gc.collect()
                context._jvm.System.gc()
    return score


def angle_entropies(
    df: DataFrame, rows: np.ndarray, thetas: list[float], *, std_dev: float, replicates: int, id_col: str = "row_id", seed: int = 0, local_values: int = LOCAL_VALUES
) -> list[float]:
    """The summed entropy of two components turned by each angle, over all points with their noisy replicas.

    A table whose replicas are at most ``local_values`` is sent to the tasks
    once (16 bytes a point and the id), and every task makes, turns and sorts the replicas for its own angles.  A
    larger one stays where it is: replicas are made and turned in place, and slices of their values are exchanged, at
    most EXCHANGED_VALUES at a time.  Both make the same replicas.
    """
    ids = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-1)).alias("_id")
    first, second = (np.asarray(r, float) for r in rows)
    pair = df.select(ids, matrix_udf(lambda x: x @ np.stack([first, second]).T)(F.col("features")).alias("ab"))
    points = df.count()
    if points * replicates > local_values:
        return _by_slices(pair, points, thetas, std_dev, replicates, seed)
    got = pair.toArrow()
    known, ab = got["_id"].to_numpy(), to_matrix(got["ab"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _replicas(known, ab[:, 0], ab[:, 1], std_dev, replicates, seed)
        z = np.empty(len(a))
        for batch in batches:
            at = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_angle_entropy(a, b, thetas[k], z) for k in at], pa.float64())], ["id", "entropy"])

    spark = df.sparkSession
    # Replicas cost a task as much as six angles do, so there are no more tasks than cores.
    tasks = min(len(thetas), spark.sparkContext.defaultParallelism)
    scored = spark.range(0, len(thetas), 1, tasks).mapInArrow(score, "id bigint, entropy double").collect()
    return [r["entropy"] for r in sorted(scored)]


def best_angle(df: DataFrame, rows: np.ndarray, *, std_dev: float, replicates: int, angles: int, id_col: str, seed: int, local_values: int = LOCAL_VALUES) -> float:
    """Angle in [0, pi/2) whose rotation of two components has the lowest summed entropy; the first of equal ones."""
    thetas = [k * math.pi / 2.0 / angles for k in range(angles)]
    scores = angle_entropies(df, rows, thetas, std_dev=std_dev, replicates=replicates, id_col=id_col, seed=seed, local_values=local_values)
    return thetas[int(np.argmin(scores))]


def fit_unmixing(
    df: DataFrame,
    *,
    std_dev: float = 0.175,
    replicates: int = 30,
    angles: int = 150,
    sweeps: int = 0,
    id_col: str = "row_id",
    seed: int = 0,
    local_values: int = LOCAL_VALUES,
) -> Unmixing:
    """Whiten, then rotate pairs of components to minimal entropy; 0 sweeps means d - 1."""
    m, cov = covariance(df)
    d = len(m.mean)
    values, vectors = np.linalg.eigh(cov)
    if values.min() <= 0:
        raise ValueError("features are linearly dependent")
    w = (vectors / np.sqrt(values)).T
    with reused(df, id_col, "features") as kept:
        for _ in range(sweeps or d - 1):
            for i in range(d - 1):
                for j in range(i + 1, d):
                    theta = best_angle(
                        kept, w[[i, j]], std_dev=std_dev, replicates=replicates, angles=angles, id_col=id_col, seed=seed, local_values=local_values
                    )
                    w = _rotation(d, i, j, theta) @ w
        objective = _objective(kept, w, id_col)
    return Unmixing(w, objective)


def _objective(df: DataFrame, w: np.ndarray, id_col: str) -> float:
    parts = unmix(df, Unmixing(w, 0.0)).select(id_col, F.posexplode("y").alias("g", "z"))
    return float(spacing_entropy(parts, "z", [id_col], "g").agg(F.sum("entropy")).first()[0])


def unmix(df: DataFrame, model: Unmixing, output_col: str = "y") -> DataFrame:
    w = model.w
    return df.withColumn(output_col, matrix_udf(lambda x: x @ w.T)(F.col("features")))
