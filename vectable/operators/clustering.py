"""k-means and mean shift.

Every k-means pass is one scan that assigns points and sums them per cluster in
the same task; only k x (d + 1) numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.functions.blocks import from_matrix, matrix_udf, nearest, row_slices, sq_dists, sum_over_rows, to_matrix
from vectable.functions.hashing import uniforms
from vectable.operators.buckets import bucket_join
from vectable.operators.layout import shape
from vectable.operators.neighbors import BROADCAST_BYTES, block_rows_of, Cells, block_join, fit_cells, neighbour_join
from vectable.operators.order import row_index, sample_rows
from vectable.session import cut_lineage, reused


@dataclass(frozen=True)
class KMeansModel:
    centroids: np.ndarray
    counts: np.ndarray
    iterations: int
    converged: bool


def _sums(x: np.ndarray, idx: np.ndarray, k: int) -> np.ndarray:
    """Per-cluster feature sums with the row count in the last column."""
    cols = [np.bincount(idx, x[:, j], k) for j in range(x.shape[1])]
    return np.stack([*cols, np.bincount(idx, minlength=k)], axis=1)


def _update(total: np.ndarray, centroids: np.ndarray, empty: str) -> tuple[np.ndarray, np.ndarray]:
    """New centroids and their counts; an empty cluster stays where it was or is dropped."""
    count = total[:, -1]
    moved = np.where(count[:, None] > 0, total[:, :-1] / np.maximum(count, 1.0)[:, None], centroids)
    if empty == "kill":
        return moved[count > 0], count[count > 0]
    return moved, count


def lloyd(df: DataFrame, start: np.ndarray, max_iterations: int = 1000, empty: str = "kill", tolerance: float = 1e-5, features_col: str = "features") -> KMeansModel:
    """Lloyd iterations from given centroids until they stop moving."""
    if empty not in ("kill", "allow"):
        raise ValueError("empty is kill or allow")
    centroids, done, count, converged = start, 0, np.zeros(len(start)), False
    limit = max_iterations if max_iterations > 0 else 2**31
    while done < limit and not converged:
        current = centroids

        def step(x: np.ndarray) -> dict[str, np.ndarray]:
            return {"t": _sums(x, nearest(x, current)[0], len(current))}

        centroids, count = _update(sum_over_rows(df, [features_col], step)["t"], current, empty)
        done += 1
        converged = len(centroids) == len(current) and bool(np.sqrt(((centroids - current) ** 2).sum()) < tolerance)
    return KMeansModel(centroids, count, done, converged)


def centroids_of(df: DataFrame, k: int, cluster_col: str = "cluster", features_col: str = "features") -> np.ndarray:
    """Means per given assignment (a start from stored assignments)."""

    def step(x: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
        return {"t": _sums(x, c.astype(np.int64), k)}

    total = sum_over_rows(df, [features_col, cluster_col], step)["t"]
    if np.any(total[:, -1] == 0):
        raise ValueError("an initial cluster has no members")
    return total[:, :-1] / total[:, -1:]


def memberships(df: DataFrame, samplings: int, percentage: float, id_col: str = "row_id", seed: int = 0, output_col: str = "members") -> DataFrame:
    """Adds the samplings that a row is in, one bit for each: sampling s takes it if draw s of (seed, id) lies below ``percentage``."""

    @F.arrow_udf("binary")
    def drawn(ids: pa.Array) -> pa.Array:
        i = ids.to_numpy()
        member = np.stack([uniforms(seed, s, i) < percentage for s in range(samplings)], 1)
        bits = np.packbits(member, axis=1)
        return pa.array([b.tobytes() for b in bits], pa.binary())

    return df.withColumn(output_col, drawn(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-1))))


def refined_start(
    df: DataFrame, k: int, *, samplings: int = 100, percentage: float = 0.02, max_iterations: int = 1000, id_col: str = "row_id", seed: int = 0
) -> np.ndarray:
    """Cluster many random samples, then their centroids from each sample's solution; the best of those is the start.

    All samples advance together: a row carries the bits of the samples it is in, drawn once, so a
    pass over the table moves every sample one step and no sample is ever gathered.
    """
    n, _ = shape(df)
    if int(n * percentage) < k:
        raise ValueError(f"samples of {int(n * percentage)} points are too small for {k} clusters")
    starts = sampled_starts(df, k, samplings, id_col, seed)
    with reused(memberships(df, samplings, percentage, id_col, seed), "features", "members") as kept:
        starts, _ = _side_by_side(kept, starts, max_iterations)
    points = starts.reshape(samplings * k, -1)
    every = bytes([255]) * (-(-samplings // 8))
    table = df.sparkSession.createDataFrame([(p.tolist(), every) for p in points], "features array<double>, members binary")
    with reused(table, "features", "members") as kept:
        found, error = _side_by_side(kept, starts, max_iterations)
    return found[int(error.argmin())]


def sampled_starts(df: DataFrame, k: int, samplings: int, id_col: str = "row_id", seed: int = 0) -> np.ndarray:
    """(samplings, k, d): the rows of the lowest hashes, k for each sampling, from the first again where the table has fewer."""
    drawn = to_matrix(sample_rows(df, samplings * k, id_col, seed).select("features").toArrow()["features"])
    return drawn[np.resize(np.arange(len(drawn)), samplings * k).reshape(samplings, k)]


def sampled_step(df: DataFrame, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(runs, k, d + 1) sums and counts by nearest centroid of every run (runs, k, d) over its members, and the squared errors.

    One matrix product gives the distances of a slice of rows to the centroids of all runs; what a run has no part in is left out.
    """
    runs, k, d = starts.shape
    flat = starts.reshape(runs * k, d)
    norms = (flat * flat).sum(1).reshape(runs, k)

    def step(x: np.ndarray, members: np.ndarray) -> dict[str, np.ndarray]:
        total, error = np.zeros((runs * k, d + 1)), np.zeros(runs)
        bits = np.unpackbits(np.frombuffer(b"".join(members.tolist()), np.uint8).reshape(len(x), -1), axis=1)[:, :runs]
        for s in row_slices(len(x), runs * max(k, d)):
            row, run = np.nonzero(bits[s])
            if not len(row):
                continue
            here = x[s]
            dist = (here @ flat.T).reshape(len(here), runs, k)[row, run] * -2.0 + norms[run]
            best = dist.argmin(1)
            # Copies of a centroid can differ in the last bits of the product form.
            slack = 1e-9 * (1.0 + (here * here).sum(1)[row])
            for r in np.array_split(np.flatnonzero((dist <= (dist.min(1) + slack)[:, None]).sum(1) > 1), max(1, len(row) * k * d // 4_000_000)):
                best[r] = ((here[row[r]][:, None, :] - starts[run[r]]) ** 2).sum(2).argmin(1)
            at = run * k + best
            gap = here[row] - flat[at]
            error += np.bincount(run, (gap * gap).sum(1), runs)
            order = np.argsort(at, kind="stable")
            begin = np.flatnonzero(np.concatenate(([True], np.diff(at[order]) > 0)))
            rows = np.hstack([here[row], np.ones((len(row), 1))])[order]
            total[at[order][begin]] += np.add.reduceat(rows, begin, axis=0)
        return {"t": total.reshape(runs, k, d + 1), "e": error}

    out = sum_over_rows(df, ["features", "members"], step)
    return out["t"], out["e"]


def _side_by_side(df: DataFrame, starts: np.ndarray, max_iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd from many starts (runs, k, d) at once; returns the centroids and the squared error of each run."""
    limit = max_iterations if max_iterations > 0 else 2**31
    for _ in range(limit):
        current = starts
        total, error = sampled_step(df, current)
        starts = np.stack([_update(t, c, "allow")[0] for t, c in zip(total, current)])
        if np.sqrt(((starts - current) ** 2).sum(axis=(1, 2))).max() < 1e-5:
            break
    return starts, error


def kmeans(
    df: DataFrame,
    clusters: int = 1,
    *,
    max_iterations: int = 1000,
    centroids: np.ndarray | None = None,
    assignments_col: str | None = None,
    refined: bool = False,
    samplings: int = 100,
    percentage: float = 0.02,
    empty: str = "kill",
    id_col: str = "row_id",
    seed: int = 0,
) -> KMeansModel:
    """k-means from stored assignments, given centroids, a refined start or sampled points (in that order)."""
    if clusters < 1:
        raise ValueError("clusters must be at least 1")
    n, dim = shape(df)
    if clusters > n:
        raise ValueError(f"{clusters} clusters asked of {n} points")
    if assignments_col is not None:
        start = centroids_of(df, clusters, assignments_col)
    elif centroids is not None:
        start = np.asarray(centroids, dtype=float)
        if start.shape != (clusters, dim):
            raise ValueError(f"initial centroids have shape {start.shape}, expected {(clusters, dim)}")
    elif refined:
        start = refined_start(
            df, clusters, samplings=samplings, percentage=percentage, max_iterations=max_iterations, id_col=id_col, seed=seed
        )
    else:
        start = to_matrix(sample_rows(df, clusters, id_col, seed).select("features").toArrow()["features"])
    with reused(df, "features") as kept:
        return lloyd(kept, start, max_iterations, empty)


def assign(df: DataFrame, centroids: np.ndarray, features_col: str = "features", output_col: str = "cluster") -> DataFrame:
    """Cluster of each point; works on batch and streaming tables."""
    return df.withColumn(output_col, matrix_udf(lambda x: nearest(x, centroids)[0], "int")(F.col(features_col)))


# --- mean shift -----------------------------------------------------------------


#: Ranges that a pass tells apart for each point, and passes: distances are found to 1 / RADIUS_BINS ** RADIUS_PASSES of their span.
RADIUS_BINS, RADIUS_PASSES = 128, 5
#: Rows of counts that one call adds up.
DEAL_ROWS = 1 << 15


def _ranged(d: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Range of each distance (rows, ..): 0 below lo, 1 to RADIUS_BINS between lo and hi, RADIUS_BINS + 1 beyond."""
    at = np.floor((d - lo) * (RADIUS_BINS / (hi - lo))) + 1
    return np.clip(at, 0, RADIUS_BINS + 1).astype(np.int64)


def _counted(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(rows, RADIUS_BINS + 1): the weights of each row by range, without what lies beyond."""
    row = np.broadcast_to(np.arange(len(at))[:, None], at.shape)
    w = np.broadcast_to(weight, at.shape)
    return np.bincount((row * (RADIUS_BINS + 2) + at).reshape(-1), w.reshape(-1), len(at) * (RADIUS_BINS + 2)).reshape(len(at), -1)[:, :-1]


def rank_distances(points: DataFrame, cells: Cells, k: int, block_rows: int | None = None) -> DataFrame:
    """(_q, weight, dist): for each of the points (_ref, _rx, weight, cell), the distance to its k-th nearest other row, copies included.

    Every point keeps a range that the distance lies in.  A pass counts all
    rows of the table in 64 parts of that range and goes on with the part
    that holds rank k.  A cell whose points all lie in one part, or all below
    or beyond the range, as its pivot distances prove, is counted by its weight and not
    visited; other cells are visited in blocks.
    """
    held = np.zeros(len(cells.pivots))
    for row in points.groupBy("cell").agg(F.sum("weight").alias("w")).collect():
        held[row["cell"]] = row["w"]
    block_rows = block_rows or block_rows_of(cells.pivots.shape[1])
    full = np.flatnonzero(cells.count > 0)
    pivots, near, far, held = cells.pivots[full], cells.near[full], cells.far[full], held[full]
    # The widest possible distance: from a point to a pivot and on to the rim of that cell.
    widest = float((np.sqrt(sq_dists(pivots, pivots)) + far[None, :]).max() + far.max()) if len(full) else 0.0

    def told(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cells): the range that a whole cell lies in, and whether it does."""
        d = np.sqrt(sq_dists(x, pivots))
        slack = 1e-6 * (1.0 + d)
        least = np.maximum(np.maximum(d - far, near - d) - slack, 0.0)
        first, last = (_ranged(v, lo[:, None], hi[:, None]) for v in (least, d + far + slack))
        return first, first == last

    def ranges(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        if batch.num_rows:
            x, lo, hi = to_matrix(batch.column(1)), batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for s in row_slices(len(x), len(full) * 8):
                yield s, x[s], lo[s], hi[s]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, x, lo, hi in ranges(batch):
                at, sure = told(x, lo, hi)
                counts = from_matrix(_counted(np.where(sure, at, RADIUS_BINS + 1), held))
                yield pa.RecordBatch.from_arrays([*[c.slice(s.start, len(x)) for c in batch.columns], counts], [*fields, "counts"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, x, lo, hi in ranges(batch):
                row, cell = np.nonzero(~told(x, lo, hi)[1])
                at = pa.array(row + s.start)
                yield pa.RecordBatch.from_arrays([pa.array(full[cell].astype(np.int64)), *[batch.column(i).take(at) for i in range(4)]], ["cell", *fields[:4]])

    def work(qs: pa.Table, rs: pa.Table) -> pa.Table:
        if not qs.num_rows or not rs.num_rows:
            return pa.table({"_q": pa.array([], pa.int64()), "counts": pa.array([], pa.list_(pa.float64()))})
        x, r, w = to_matrix(qs["_qx"]), to_matrix(rs["_rx"]), rs["weight"].to_numpy().astype(float)
        lo, hi = qs["lo"].to_numpy(), qs["hi"].to_numpy()
        counts = np.concatenate([_counted(_ranged(np.sqrt(sq_dists(x[s], r)), lo[s][:, None], hi[s][:, None]), w) for s in row_slices(len(x), len(r))])
        return pa.table({"_q": qs["_q"], "counts": from_matrix(counts)})

    def narrowed(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group["_q"].to_numpy(), kind="stable")))
        q, own = group["_q"].to_numpy(), group.filter(group["weight"].is_valid())
        counts = np.add.reduceat(to_matrix(group["counts"]), np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))), axis=0)
        # The row itself is one of those at distance 0, so the k-th other one has rank k + 1.
        part = np.clip((np.cumsum(counts, 1) < k + 1).sum(1), 1, RADIUS_BINS)
        lo, hi = own["lo"].to_numpy(), own["hi"].to_numpy()
        step = (hi - lo) / RADIUS_BINS
        return pa.table([own["_q"], own["_qx"], pa.array(lo + (part - 1) * step), pa.array(lo + part * step), own["weight"]], fields)

    fields = ["_q", "_qx", "lo", "hi", "weight"]
    kinds = "_q bigint, _qx array<double>, lo double, hi double"
    reference = points.select(F.col("cell").cast("bigint").alias("cell"), "_ref", "_rx", "weight")
    state = points.select(F.col("_ref").alias("_q"), F.col("_rx").alias("_qx"), F.lit(0.0).alias("lo"), F.lit(widest * (1 + 1e-6) + 1e-12).alias("hi"), "weight")
    for _ in range(RADIUS_PASSES):
        asked = state.mapInArrow(visits, f"cell bigint, {kinds}")
        load = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
        loads = points.sparkSession.createDataFrame([(c, n, int(cells.count[c])) for c, n in load.items()], "cell bigint, nq bigint, nr bigint")
        met = bucket_join(asked, reference, ["cell"], work, "_q bigint, counts array<double>", block_rows, loads)
        known = state.mapInArrow(whole, f"{kinds}, weight bigint, counts array<double>")
        rows = int(cells.count.sum()) + sum(n * -(-int(cells.count[c]) // block_rows) for c, n in load.items())
        deal = F.pmod(F.xxhash64("_q"), F.lit(max(1, -(-rows // DEAL_ROWS))))
        both = known.unionByName(met, allowMissingColumns=True)
        state = cut_lineage(both.groupBy(deal.alias("deal")).applyInArrow(narrowed, f"{kinds}, weight bigint"))
    return state.select("_q", "weight", ((F.col("lo") + F.col("hi")) / 2).alias("dist"))


#: Lines that a point is measured against, distinct points that a task holds on them, and halvings that find a distance.
MAX_LINES, LINE_POINTS, HALVINGS = 1024, 8_000_000, 45


@dataclass(frozen=True)
class Lines:
    """Distinct points on few lines along one feature: on each line points agree in all other features and lie by value."""

    axis: int
    others: np.ndarray  # (lines, d - 1)
    start: np.ndarray  # (lines + 1,)
    values: np.ndarray
    before: np.ndarray | None  # weight of the points before each one, where copies weigh more than 1

    def within(self, x: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Weight of the points no farther from each row than its r."""
        v, rest = x[:, self.axis], np.delete(x, self.axis, 1)
        found = np.zeros(len(x))
        for other, lo, hi in zip(self.others, self.start[:-1], self.start[1:]):
            room = r * r - ((rest - other) ** 2).sum(1)
            at = np.flatnonzero(room >= 0)
            half, line = np.sqrt(room[at]), self.values[lo:hi]
            first = lo + np.searchsorted(line, v[at] - half, "left")
            last = lo + np.searchsorted(line, v[at] + half, "right")
            found[at] += last - first if self.before is None else self.before[last] - self.before[first]
        return found

    def rank_distance(self, x: np.ndarray, k: int, widest: float) -> np.ndarray:
        """Distance of each of the held rows to its k-th nearest other one; the row itself is counted as well."""
        lo, hi = np.zeros(len(x)), np.full(len(x), widest)
        for _ in range(HALVINGS):
            mid = (lo + hi) / 2
            reached = self.within(x, mid) > k
            lo, hi = np.where(reached, lo, mid), np.where(reached, mid, hi)
        return (lo + hi) / 2


def fit_lines(distinct: DataFrame, m: int) -> Lines | None:
    """The m distinct points (_rx, weight) as lines; None where they are too many, lie on too many lines, or have values that are not finite."""
    d = distinct.select(F.size("_rx")).first()[0]
    if not d or not 1 <= d <= 4 or m > LINE_POINTS:
        return None
    parts = [F.get("_rx", F.lit(i)) for i in range(d)]
    rest = [F.array(*[p.cast("double") for j, p in enumerate(parts) if j != i]) for i in range(d)]
    odd = F.exists("_rx", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    seen = distinct.agg(*[F.approx_count_distinct(r) for r in rest], F.max((F.size("_rx") != d) | odd)).first()
    axis = int(np.argmin(seen[:d]))
    if seen[d] or seen[axis] > MAX_LINES or seen[axis] * 32 > m:
        return None
    got = distinct.select("_rx", F.col("weight").cast("int").alias("weight")).toArrow()
    x, weight = to_matrix(got["_rx"]), got["weight"].to_numpy()
    others, line = np.unique(np.delete(x, axis, 1), axis=0, return_inverse=True)
    order = np.lexsort((x[:, axis], line.reshape(-1)))
    start = np.concatenate(([0], np.cumsum(np.bincount(line.reshape(-1), minlength=len(others)))))
    before = None if (weight == 1).all() else np.concatenate(([0], np.cumsum(weight[order], dtype=np.int64)))
    return Lines(axis, others, start, x[order, axis], before)


def line_distances(distinct: DataFrame, lines: Lines, m: int, k: int) -> DataFrame:
    """(weight, dist): for each distinct point the distance to its k-th nearest other row, copies included, by counts on sorted lines."""
    spans = [np.ptp(lines.others, 0), [np.ptp(lines.values)]]
    widest = float(np.sqrt((np.concatenate(spans) ** 2).sum())) * (1 + 1e-6) + 1e-12

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = to_matrix(batch.column(0))
                # Rows in the order of the line look in the same places.
                order = np.argsort(x[:, lines.axis], kind="stable")
                dist = np.empty(len(x))
                dist[order] = lines.rank_distance(x[order], k, widest)
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(dist)], ["weight", "dist"])

    # Work is by points, not by bytes: few bytes are spread over all cores.
    tasks = max(1, min(4 * distinct.sparkSession.sparkContext.defaultParallelism, -(-m // 1000)))
    return distinct.select("_rx", "weight").repartition(tasks).mapInArrow(found, "weight bigint, dist double")


def estimate_radius(df: DataFrame, ratio: float = 0.2, id_col: str = "row_id", n_pivots: int | None = None) -> float:
    """Mean over all points of the distance to the (ratio x n)-th nearest of the other ones.

    Points on few lines along one feature are counted by searches on the sorted lines, others by cells.
    """
    distinct = cut_lineage(distinct_points(df, id_col))
    totals = distinct.agg(F.count("*").alias("m"), F.sum("weight").alias("n")).first()
    n = totals["n"] or 0
    if n < 2:
        raise ValueError("a radius takes at least two points")
    k = min(n - 1, max(1, int(ratio * n)))
    lines = fit_lines(distinct, totals["m"]) if n_pivots is None else None
    if lines is not None:
        found = line_distances(distinct, lines, totals["m"], k)
    else:
        cells, points = fit_cells(distinct, totals["m"], 1, n_pivots=n_pivots)
        found = rank_distances(points, cells, k)
    return float(found.agg(F.sum(F.col("dist") * F.col("weight")) / F.sum("weight")).first()[0])


def _within(
    query: DataFrame, cells: Cells, placed: DataFrame, radius: float, fold: Callable, schema: str, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Per query and block, ``fold`` the reference rows within the radius."""
    empty = fold(None, None, None).schema.empty_table()

    def work(qs: pa.Table, rs: pa.Table) -> pa.Table:
        if qs.num_rows == 0 or rs.num_rows == 0:
            return empty
        x, r = to_matrix(qs["_qx"]), to_matrix(rs["_rx"])
        parts = []
        for s in row_slices(len(x), len(r)):
            near = sq_dists(x[s], r) <= radius * radius
            parts.append(fold(qs["_q"].to_numpy()[s], near, rs))
        return pa.concat_tables(parts)

    return block_join(query, placed, cells, lambda x: cells.within(x, radius), work, schema, block_rows_of(cells.pivots.shape[1]), extra)


def shift_once(seeds: DataFrame, cells: Cells, points: DataFrame, radius: float) -> DataFrame:
    """(_q, count, center): weighted mean of the points within the radius of each seed.

    ``points`` holds one row per distinct point with its number of copies, cut into cells.
    """

    def fold(q: np.ndarray | None, near: np.ndarray | None, rs: pa.Table | None) -> pa.Table:
        if q is None:
            return pa.table({"_q": pa.array([], pa.int64()), "w": pa.array([], pa.float64()), "v": pa.array([], pa.list_(pa.float64()))})
        w = rs["weight"].to_numpy().astype(float)
        hits = near * w
        got = near.any(1)
        return pa.table({"_q": q[got], "w": hits.sum(1)[got], "v": from_matrix((hits @ to_matrix(rs["_rx"]))[got])})

    part = _within(seeds, cells, points, radius, fold, "_q bigint, w double, v array<double>", ("weight",))
    cells = part.select("_q", "w", F.posexplode("v").alias("i", "v"))
    sums = cells.groupBy("_q", "i").agg(F.sum("w").alias("w"), F.sum("v").alias("v"))
    means = sums.groupBy("_q").agg(
        F.first("w").alias("count"), F.array_sort(F.collect_list(F.struct("i", (F.col("v") / F.col("w")).alias("m")))).alias("m")
    )
    return means.select("_q", "count", F.transform("m", lambda c: c["m"]).alias("center"))


#: Seeds that every task holds; a pass over the points then moves all of them.
FEW_SEEDS = 1024


def _moved(points: DataFrame, at: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, centers) of few seeds: the same as ``shift_once`` by one scan that sums per seed where the points lie."""

    def step(x: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        total = np.zeros((len(at), x.shape[1] + 1))
        for s in row_slices(len(x), len(at), 500_000):
            near = (sq_dists(at, x[s]) <= radius * radius).astype(float)
            total += near @ (np.column_stack((x[s], np.ones(s.stop - s.start))) * weight[s, None])
        return {"t": total}

    total = sum_over_rows(points, ["_rx", "weight"], step)["t"]
    return total[:, -1], total[:, :-1] / np.maximum(total[:, -1:], 1.0)


def _rested(move: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], at: np.ndarray, radius: float, max_iterations: int, force_convergence: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(which seeds meet points, places where all came to rest, passes); ``move`` gives the weights and centers of seeds."""
    at, alive, moving, done = at.copy(), np.ones(len(at), bool), np.ones(len(at), bool), 0
    while moving.any() and (done < max_iterations or force_convergence):
        here = np.flatnonzero(moving)
        weight, center = move(at[here])
        rests = np.sqrt(((at[here] - center) ** 2).sum(1)) < 1e-3 * radius
        alive[here], moving[here] = weight > 0, (weight > 0) & ~rests
        at[here] = center
        done += 1
    return alive, at, done


@dataclass(frozen=True)
class Held:
    """Distinct points with their weights in the order of their widest feature: a seed meets a run of them."""

    axis: int
    points: np.ndarray
    weighed: np.ndarray  # (points, d + 1): features times weight, and the weight

    @classmethod
    def of(cls, points: np.ndarray, weight: np.ndarray) -> Held | None:
        """None where values are not finite."""
        if not np.isfinite(points).all():
            return None
        axis = int(np.argmax(np.ptp(points, 0))) if points.size else 0
        order = np.argsort(points[:, axis], kind="stable") if points.size else np.arange(len(points))
        points, weight = points[order], weight[order].astype(float)
        return cls(axis, points, np.column_stack((points * weight[:, None], weight)))

    def moved(self, at: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``_moved``."""
        total = np.zeros((len(at), self.weighed.shape[1]))
        line = self.points[:, self.axis]
        reach = radius * (1.0 + 1e-9) + 1e-12 * np.abs(at[:, self.axis])
        first, last = np.searchsorted(line, at[:, self.axis] - reach, "left"), np.searchsorted(line, at[:, self.axis] + reach, "right")
        for i in range(len(at)):
            for s in row_slices(last[i] - first[i], 1, 1 << 16):
                run = slice(first[i] + s.start, first[i] + s.stop)
                near = sq_dists(at[i : i + 1], self.points[run])[0] <= radius * radius
                total[i] += near @ self.weighed[run]
        return total[:, -1], total[:, :-1] / np.maximum(total[:, -1:], 1.0)


def _rested_apart(
    points: DataFrame, held: Held, at: np.ndarray, radius: float, max_iterations: int, force_convergence: bool
) -> tuple[np.ndarray, np.ndarray, int]:
    """``_rested`` in one job: a seed moves without regard to the others, so each task moves seeds of its own until they rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch.column(0).to_numpy()
                alive, rested, done = _rested(lambda x: held.moved(x, radius), at[own], radius, max_iterations, force_convergence)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(alive), from_matrix(rested), pa.array(np.full(len(own), done))], ["id", "alive", "at", "done"])

    spark = points.sparkSession
    tasks = max(1, min(len(at), 4 * spark.sparkContext.defaultParallelism))
    got = spark.range(0, len(at), 1, tasks).mapInArrow(run, "id bigint, alive boolean, at array<double>, done bigint").toArrow()
    got = got.take(pa.array(np.argsort(got["id"].to_numpy())))
    return got["alive"].to_numpy(), to_matrix(got["at"]), int(got["done"].to_numpy().max(initial=0))


def _apart(centers: np.ndarray, radius: float) -> np.ndarray:
    """``first_in_reach`` of few centers, given by rising rank."""
    kept: list[int] = []
    for i, c in enumerate(centers):
        if not (sq_dists(c[None, :], centers[kept]) <= radius * radius).any():
            kept.append(i)
    return centers[kept]


def distinct_points(df: DataFrame, id_col: str = "row_id", features_col: str = "features") -> DataFrame:
    """(_ref, _rx, weight): copies of a point are counted before anything is shuffled further."""
    return df.groupBy(F.col(features_col).alias("_rx")).agg(F.min(id_col).cast("bigint").alias("_ref"), F.count("*").alias("weight"))


def bin_seeds(df: DataFrame, radius: float) -> DataFrame:
    """(_q, _qx): one start per occupied grid cell of side ``radius``, at the cell's corner."""
    corner = F.transform("features", lambda x: F.floor(x / F.lit(radius)) * F.lit(radius))
    corners = cut_lineage(df.select(corner.cast("array<double>").alias("_qx")).distinct())
    return corners.select(F.monotonically_increasing_id().alias("_q"), "_qx")


def first_in_reach(centers: DataFrame, radius: float) -> DataFrame:
    """Keep centers that no kept center with a lower rank lies closer than ``radius`` to.

    Rounds of: an undecided center that is the lowest undecided one in its reach is kept,
    and takes out the undecided centers it reaches.  Each round is two radius joins.
    """

    def lowest(q: np.ndarray | None, near: np.ndarray | None, rs: pa.Table | None) -> pa.Table:
        if q is None:
            return pa.table({"_q": pa.array([], pa.int64()), "low": pa.array([], pa.int64())})
        ids = rs["_ref"].to_numpy()
        got = near.any(1)
        low = np.where(near, ids[None, :], np.iinfo(np.int64).max).min(1)
        return pa.table({"_q": q[got], "low": low[got]})

    undecided, kept = centers, None
    while True:
        left = undecided.count()
        if left == 0:
            return kept
        ref = undecided.select(F.col("_q").alias("_ref"), F.col("_qx").alias("_rx"))
        low = _within(undecided, *fit_cells(ref, left, 1), radius, lowest, "_q bigint, low bigint").groupBy("_q").agg(F.min("low").alias("low"))
        fresh = cut_lineage(undecided.join(low.filter(F.col("low") == F.col("_q")).select("_q"), "_q"))
        kept = fresh if kept is None else kept.unionByName(fresh)
        ref = fresh.select(F.col("_q").alias("_ref"), F.col("_qx").alias("_rx"))
        reached = _within(undecided, *fit_cells(ref, fresh.count(), 1), radius, lowest, "_q bigint, low bigint").select("_q").distinct()
        undecided = cut_lineage(undecided.join(reached, "_q", "left_anti"))


@dataclass(frozen=True)
class MeanShift:
    centroids: DataFrame  # (cluster, features)
    radius: float
    iterations: int


def mean_shift(
    df: DataFrame, radius: float = 0.0, *, max_iterations: int = 1000, force_convergence: bool = False, id_col: str = "row_id", seed: int = 0
) -> MeanShift:
    """Shift every seed to the mean of the points within the radius until it rests, then merge.

    Seeds that still move after ``max_iterations`` count where they are;
    ``force_convergence`` goes on until all of them rest.  Up to ``FEW_SEEDS`` seeds go to the tasks: with the distinct points,
    where those were counted below the broadcast limit, so that one job moves all seeds; else a
    pass is one scan.  More seeds meet the points by cells.
    """
    r = radius if radius > 0 else estimate_radius(df, id_col=id_col)
    seeds = cut_lineage(bin_seeds(df, r))
    known = seeds.limit(FEW_SEEDS + 1).toArrow()
    if known.num_rows <= FEW_SEEDS:
        at = to_matrix(known["_qx"])[np.argsort(known["_q"].to_numpy())]
        with reused(distinct_points(df, id_col), "_rx", "weight") as points:
            size = points.count() * 8 * (2 * at.shape[1] + 1)
            if 0 < size <= BROADCAST_BYTES and len(at):
                got = points.select("_rx", "weight").toArrow()
                held = Held.of(to_matrix(got["_rx"]), got["weight"].to_numpy())
            else:
                held = None
            if held is not None:
                alive, rested, done = _rested_apart(points, held, at, r, max_iterations, force_convergence)
            else:
                alive, rested, done = _rested(lambda x: _moved(points, x, r), at, r, max_iterations, force_convergence)
        centers = df.sparkSession.createDataFrame([(c.tolist(),) for c in _apart(rested[alive], r)], "features array<double>")
        return MeanShift(row_index(centers, ["features"], "cluster"), r, done)
    distinct = cut_lineage(distinct_points(df, id_col))
    cells, points = fit_cells(distinct, distinct.count(), 1)
    moving, settled, done = seeds, None, 0
    while done < max_iterations or force_convergence:
        step = moving.join(shift_once(moving, cells, points, r), "_q")
        gap = F.aggregate(F.zip_with("_qx", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
        moved = cut_lineage(step.select("_q", F.col("center").alias("_qx"), (F.sqrt(gap) < 1e-3 * r).alias("rests")))
        done += 1
        rest = moved.filter("rests").drop("rests")
        settled = rest if settled is None else settled.unionByName(rest)
        moving = moved.filter("not rests").drop("rests")
        if moving.isEmpty():
            break
    settled = moving if settled is None else settled.unionByName(moving)
    centers = first_in_reach(cut_lineage(settled), r)
    return MeanShift(row_index(centers.select(F.col("_qx").alias("features")), ["features"], "cluster"), r, done)


def mean_shift_assign(df: DataFrame, model: MeanShift, *, beyond_radius: bool = True, id_col: str = "row_id") -> DataFrame:
    """(id, cluster): the nearest centroid; without ``beyond_radius`` NULL for points farther away than the radius."""
    hits = neighbour_join(df, model.centroids, 1, query_id=id_col, ref_id="cluster")
    label = F.col("ref_id") if beyond_radius else F.when(F.col("dist") <= model.radius, F.col("ref_id"))
    return hits.select(F.col("query_id").alias(id_col), label.alias("cluster"))
