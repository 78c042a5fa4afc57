"""Nearest- and farthest-neighbour joins.

Three strategies give the same rows:

* a reference set of checked size is sent to the tasks once, and the query side
  is scored where it lies, without a shuffle;
* a larger one is cut into cells around pivot points.  Per query, distances to the
  pivots bound the distance of its k-th neighbour, and only cells that can hold a
  closer point are visited.  Cells and the queries routed to them are cut into
  blocks of bounded size, so neither a dense region nor a third of all rows being
  copies of one point lands in one task.  Copies of a reference point beyond the k
  lowest ids can never be among k neighbours and leave before the blocks are built;
* where bounds exclude few cells, as in many dimensions, copies for cells are copies for nothing: blocks of queries
  meet blocks of the reference set one by one, and only the k best of each meeting are exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectable.functions.blocks import nearest, row_slices, sq_dists, to_matrix
from vectable.functions.hashing import row_hash
from vectable.operators.layout import shape
from vectable.operators.order import sample_rows
from vectable.session import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 16 * 1024 * 1024
MAX_PIVOTS = 1024
#: Numbers in a reference set from which on its queries are dealt over all cores.
SPREAD_NUMBERS = 500_000
#: Blocks grow with the table, up to what a task can hold, so that a row is copied about so many times.
BLOCK_COPIES = 16


def block_rows_of(dim: int) -> int:
    """Rows of a block: a query is copied once for every block of a cell it visits, so blocks are as large as tasks can hold."""
    return max(1024, BLOCK_BYTES // (8 * dim + 16))


@dataclass(frozen=True)
class Line:
    """Points of one feature by value, no more than the k lowest ids of each, to be searched in place.

    ``rising`` has the ids of equal values upwards, ``falling`` downwards, so
    a walk to either side meets the lowest ids of a value first.
    """

    values: np.ndarray
    rising: np.ndarray
    falling: np.ndarray

    @classmethod
    def of(cls, ref: np.ndarray, ids: np.ndarray, k: int) -> Line | None:
        """None where a search of all points is as good: several features, few points, values that are not finite."""
        if ref.shape[1] != 1 or len(ref) <= 3 * k or not np.isfinite(ref).all():
            return None
        order = np.lexsort((ids, ref[:, 0]))
        values, ids = ref[order, 0], ids[order]
        first = np.searchsorted(values, values, "left")
        keep = np.arange(len(values)) - first < k
        values, ids = values[keep], ids[keep]
        if len(values) <= 3 * k:
            return None
        return cls(values, ids, ids[np.lexsort((-ids, values))])

    def best(self, x: np.ndarray, k: int, farthest: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``top_k``: k candidates from either side, then exact distances, then rows with more that are as good."""
        n, v = len(self.values), x[:, 0]
        steps = np.arange(k)
        if farthest:
            left, right = np.tile(steps, (len(v), 1)), np.tile(n - 1 - steps, (len(v), 1))
            side_ids = np.concatenate((self.rising[left], self.falling[right]), 1)
        else:
            at = np.searchsorted(self.values, v, "left")[:, None]
            left, right = at - 1 - steps, at + steps
            side_ids = np.concatenate((self.falling[np.maximum(left, 0)], self.rising[np.minimum(right, n - 1)]), 1)
        there = np.concatenate((left >= 0, right < n), 1)
        diff = self.values[np.clip(np.concatenate((left, right), 1), 0, n - 1)] - v[:, None]
        exact = np.where(there, diff * diff, np.inf)
        exact, side_ids = _ordered(exact, side_ids, k, farthest)
        reach = np.sqrt(exact[:, -1])
        slack = 1e-14 * (np.abs(v) + reach) + 1e-150
        if farthest:
            lo, hi = np.searchsorted(self.values, v - (reach - slack), "right"), np.searchsorted(self.values, v + (reach - slack), "left")
            found = lo + n - hi
        else:
            lo, hi = np.searchsorted(self.values, v - reach - slack, "left"), np.searchsorted(self.values, v + reach + slack, "right")
            found = hi - lo
        for r in np.flatnonzero(found > k):
            cand = np.unique(np.concatenate((np.arange(lo[r]), np.arange(hi[r], n)))) if farthest else np.arange(lo[r], hi[r])
            diff = self.values[cand] - v[r]
            one, two = _ordered((diff * diff)[None, :], self.rising[cand][None, :], k, farthest)
            exact[r], side_ids[r] = one[0], two[0]
        return side_ids, np.sqrt(exact)

    def search(self, x: np.ndarray, k: int, farthest: bool) -> tuple[np.ndarray, np.ndarray]:
        if np.isfinite(x).all():
            return self.best(x, k, farthest)
        order = np.argsort(self.rising, kind="stable")
        return _compared(x, self.values[order, None], self.rising[order], k, farthest)


def _ordered(exact: np.ndarray, ids: np.ndarray, k: int, farthest: bool) -> tuple[np.ndarray, np.ndarray]:
    """The k best of every row, ties by lower id."""
    order = np.lexsort((ids, -exact if farthest else exact), axis=1)[:, :k]
    return np.take_along_axis(exact, order, 1), np.take_along_axis(ids, order, 1)


def top_k(x: np.ndarray, ref: np.ndarray, ids: np.ndarray, k: int, farthest: bool) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k best of ``ref`` for each row of ``x``, ties by lower id.

    ``ids`` ascend.  Points of one feature are sorted and searched in place, others are all compared.
    """
    line = Line.of(ref, ids, k)
    return _compared(x, ref, ids, k, farthest) if line is None else line.search(x, k, farthest)


#: Points from which on a search goes by tiles, rows of queries and points of a tile, and candidates that are kept without exact distances.
TILED_FROM, TILE_ROWS, TILE_POINTS, TILE_HELD = 4096, 256, 2048, 500_000


def _exact_best(x: np.ndarray, ref: np.ndarray, row: np.ndarray, col: np.ndarray, k: int, farthest: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places, squared distances) of the k best candidates of each row, rows rising, ties by lower place."""
    exact = np.empty(len(row))
    for s in row_slices(len(row), ref.shape[1]):
        diff = ref[col[s]] - x[row[s]]
        exact[s] = (diff * diff).sum(1)
    order = np.lexsort((col, -exact if farthest else exact, row))
    first = np.searchsorted(row[order], np.arange(len(x)), "left")
    best = order[np.arange(len(order)) - first[row[order]] < k]
    return best, exact[best]


def _tiled(x: np.ndarray, ref: np.ndarray, ids: np.ndarray, k: int, farthest: bool) -> tuple[np.ndarray, np.ndarray] | None:
    """The same as ``_compared`` tile by tile: one product in single precision, one comparison with what the k-th best so far allows.

    Exact differences decide among the few that pass.  None where single precision could overflow, or values are not finite.
    """
    size = np.sqrt(max((ref * ref).sum(1).max(initial=0.0), (x * x).sum(1).max(initial=0.0)))
    if not 1e-12 < size < 1e15:
        return None
    sign = 1.0 if farthest else -1.0
    half = (ref * ref).sum(1) / 2.0
    # Half the squared distance but for a constant of the row; the smaller, the better.
    against = np.column_stack((sign * ref, -sign * half)).astype(np.float32)
    asked = np.column_stack((x, np.ones(len(x)))).astype(np.float32)
    error = (ref.shape[1] + 8) * 2.0**-22 * (np.sqrt((x * x).sum(1)) + size) * size
    out_ids, out_d = np.empty((len(x), k), dtype=np.int64), np.empty((len(x), k))
    for lo in range(0, len(x), TILE_ROWS):
        q = slice(lo, min(lo + TILE_ROWS, len(x)))
        m, slack = q.stop - lo, 2.0 * error[q]
        limit, held, count = np.full(m, np.inf), [], 0
        settled = TILE_POINTS
        for c in range(0, len(ref), TILE_POINTS):
            g = asked[q] @ against[c : c + TILE_POINTS].T
            if c == 0:
                limit = np.partition(g, k - 1, axis=1)[:, k - 1] + slack
            hit = np.flatnonzero(g <= limit[:, None].astype(np.float32))
            if len(hit):
                row = hit // g.shape[1]
                held.append((row, c + hit % g.shape[1], g.reshape(-1)[hit].astype(float)))
                count += len(hit)
            if c + TILE_POINTS >= 2 * settled or count > TILE_HELD:
                settled = max(settled, c + TILE_POINTS)
                row, col, score = (np.concatenate(v) for v in zip(*held))
                order = np.lexsort((score, row))
                first = np.searchsorted(row[order], np.arange(m), "left")
                limit = score[order[first + k - 1]] + slack
                near = score <= limit[row]
                row, col, score = row[near], col[near], score[near]
                if len(row) > TILE_HELD // 2:
                    best, _ = _exact_best(x[q], ref, row, col, k, farthest)
                    row, col, score = row[best], col[best], score[best]
                held, count = [(row, col, score)], len(row)
        row, col = (np.concatenate(v) for v in list(zip(*held))[:2])
        best, exact = _exact_best(x[q], ref, row, col, k, farthest)
        out_ids[q], out_d[q] = ids[col[best]].reshape(m, k), np.sqrt(exact).reshape(m, k)
    return out_ids, out_d


#: Points from which boxes are worth building, features up to which they exclude much, points of a box, and queries that are answered together.
BOXED_FROM, BOXED_DIMS, BOX_POINTS, BOX_QUERIES = 1024, 8, 32, 256


@dataclass(frozen=True)
class Boxes:
    """Points of few features in a tree of boxes: each box is halved across its widest feature until it holds BOX_POINTS at most.

    Node i has the children 2 i + 1 and 2 i + 2; all leaves lie at one depth.
    """

    points: np.ndarray
    places: np.ndarray  # places of the points in the table they are from
    start: np.ndarray  # (nodes,): where the points of a node begin, and end
    end: np.ndarray
    low: np.ndarray  # (nodes, d)
    high: np.ndarray
    axis: np.ndarray  # of an inner node, and the least value across it of its second child
    wall: np.ndarray

    @classmethod
    def of(cls, ref: np.ndarray) -> Boxes:
        depth = max(1, int(np.ceil(np.log2(len(ref) / BOX_POINTS))))
        inner, nodes = 2**depth - 1, 2 ** (depth + 1) - 1
        order, points = np.arange(len(ref)), ref.copy()
        start, end = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        low, high = np.empty((nodes, ref.shape[1])), np.empty((nodes, ref.shape[1]))
        axis, wall = np.zeros(inner, np.int64), np.zeros(inner)
        end[0] = len(ref)
        for i in range(nodes):
            lo, hi = start[i], end[i]
            own = points[lo:hi]
            low[i], high[i] = own.min(0), own.max(0)
            if i < inner:
                j, mid = int(np.argmax(high[i] - low[i])), (hi - lo) // 2
                by = np.argpartition(own[:, j], mid)
                points[lo:hi], order[lo:hi] = own[by], order[lo:hi][by]
                axis[i], wall[i] = j, points[lo + mid, j]
                start[2 * i + 1], end[2 * i + 1], start[2 * i + 2], end[2 * i + 2] = lo, lo + mid, lo + mid, hi
        return cls(points, order, start, end, low, high, axis, wall)

    def _pairs(self, row: np.ndarray, node: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place among the points, squared distance) of rows and the points of nodes that they visit."""
        size = self.end[node] - self.start[node]
        at = np.repeat(self.start[node] - np.cumsum(size) + size, size) + np.arange(size.sum())
        row = np.repeat(row, size)
        exact = np.zeros(len(at))
        for j in range(x.shape[1]):
            diff = x[row, j] - self.points[at, j]
            exact += diff * diff
        return row, at, exact

    def _best(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, squared distances) of the k nearest of each row, ties by lower place."""
        rows, inner = np.arange(len(x)), len(self.axis)
        # The lowest node around a row that holds k points for sure bounds the distance of its k-th neighbour.
        home = np.zeros(len(x), np.int64)
        while 2 * home[0] + 1 < len(self.start) and (len(self.points) >> int(home[0] + 1).bit_length()) > k:
            home = 2 * home + 1 + (x[rows, self.axis[home]] >= self.wall[home])
        row, _, exact = self._pairs(rows, home, x)
        first = np.searchsorted(row, rows, "left")
        reach = exact[np.lexsort((exact, row))][first + k - 1] * (1.0 + 1e-9)
        node = np.zeros(len(x), np.int64)
        while node.size and node[0] < inner:
            rows = np.concatenate((rows, rows))
            node = np.concatenate((2 * node + 1, 2 * node + 2))
            least = np.zeros(len(rows))
            for j in range(x.shape[1]):
                v = x[rows, j]
                gap = np.maximum(np.maximum(self.low[node, j] - v, v - self.high[node, j]), 0.0)
                least += gap * gap
            near = least <= reach[rows]
            rows, node = rows[near], node[near]
        found, where, dist = [], [], []
        for s in row_slices(len(rows), BOX_POINTS):
            row, at, exact = self._pairs(rows[s], node[s], x)
            near = exact <= reach[row]
            found.append(row[near])
            where.append(self.places[at[near]])
            dist.append(exact[near])
        row, place, exact = np.concatenate(found), np.concatenate(where), np.concatenate(dist)
        order = np.lexsort((place, exact, row))
        first = np.searchsorted(row[order], np.arange(len(x)), "left")
        best = order[first[:, None] + np.arange(k)]
        return place[best], exact[best]

    def search(self, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``_compared`` for the nearest ones."""
        out_ids, out_d = np.empty((len(x), k), dtype=np.int64), np.empty((len(x), k))
        for s in row_slices(len(x), 1, BOX_QUERIES):
            place, exact = self._best(x[s], k)
            out_ids[s], out_d[s] = ids[place], np.sqrt(exact)
        return out_ids, out_d


def boxed(ref: np.ndarray, k: int, farthest: bool) -> bool:
    """Whether boxes exclude much: near ones among many points of few features, all finite."""
    return not farthest and len(ref) >= BOXED_FROM and 1 < ref.shape[1] <= BOXED_DIMS and k <= BOXED_FROM // 8 and bool(np.isfinite(ref).all())


def _compared(x: np.ndarray, ref: np.ndarray, ids: np.ndarray, k: int, farthest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Products preselect, then exact differences decide the order."""
    k = min(k, len(ref))
    if len(x) >= BOXED_FROM // 32 and boxed(ref, k, farthest) and np.isfinite(x).all():
        return Boxes.of(ref).search(x, ids, k)
    if len(ref) >= TILED_FROM and k <= TILE_POINTS // 8 and ref.shape[1] > 4 and len(x):
        found = _tiled(x, ref, ids, k, farthest)
        if found is not None:
            return found
    out_ids = np.empty((len(x), k), dtype=np.int64)
    out_d = np.empty((len(x), k))
    norms = np.sqrt((ref * ref).sum(1)).max(initial=0.0)
    sign = -1.0 if farthest else 1.0
    for s in row_slices(len(x), max(len(ref), k * ref.shape[1])):
        d = sign * sq_dists(x[s], ref)
        picked = np.argpartition(d, k - 1, axis=1)[:, :k]
        kth = np.take_along_axis(d, picked, 1).max(1)
        slack = 1e-10 * (1.0 + (norms + np.sqrt((x[s] * x[s]).sum(1))) ** 2)
        close = d <= (kth + slack)[:, None]
        picked.sort(1)
        diff = ref[picked] - x[s][:, None, :]
        exact = (diff * diff).sum(2)
        order = np.argsort(sign * exact, axis=1, kind="stable")
        out_ids[s] = ids[np.take_along_axis(picked, order, 1)]
        out_d[s] = np.sqrt(np.take_along_axis(exact, order, 1))
        # Rows with further points about as good as their k-th one.
        for r in np.flatnonzero(close.sum(1) > k):
            cand = np.flatnonzero(close[r])
            diff = ref[cand] - x[s.start + r]
            exact = (diff * diff).sum(1)
            order = np.argsort(sign * exact, kind="stable")[:k]
            out_ids[s.start + r] = ids[cand[order]]
            out_d[s.start + r] = np.sqrt(exact[order])
    return out_ids, out_d


HIT = "array<struct<ref_id:bigint,dist:double>>"


def _hits(ids: np.ndarray, dists: np.ndarray) -> pa.Array:
    n, k = ids.shape
    items = pa.StructArray.from_arrays([pa.array(ids.reshape(-1)), pa.array(dists.reshape(-1))], names=["ref_id", "dist"])
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), items)


def _small_reference(query: DataFrame, ref: DataFrame, k: int, farthest: bool, exclude_self: bool) -> DataFrame:
    got = ref.select("_ref", "_rx").toArrow()
    ids = got["_ref"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], to_matrix(got["_rx"])[order]
    line = Line.of(points, ids, k + exclude_self)
    if line is not None:
        ids = points = None
    boxes = Boxes.of(points) if line is None and boxed(points, k + exclude_self, farthest) else None
    if line is None and points.size >= SPREAD_NUMBERS and not query.isStreaming:
        # Seconds go by pairs, not by bytes: a file or two of queries would be as many tasks.
        spark = query.sparkSession
        query = query.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    @F.arrow_udf(HIT)
    def search(x: pa.Array) -> pa.Array:
        if len(x) == 0:
            return pa.array([], type=pa.list_(pa.struct([("ref_id", pa.int64()), ("dist", pa.float64())])))
        m = to_matrix(x)
        if boxes is not None and np.isfinite(m).all():
            return _hits(*boxes.search(m, ids, k + exclude_self))
        return _hits(*(_compared(m, points, ids, k + exclude_self, farthest) if line is None else line.search(m, k + exclude_self, farthest)))

    hits = query.select("_q", search("_qx").alias("hits"))
    if exclude_self:
        hits = hits.select("_q", F.slice(F.filter("hits", lambda h: h["ref_id"] != F.col("_q")), 1, k).alias("hits"))
    # The outer form: the inner one adds a non-empty filter that would search twice.
    found = hits.select("_q", F.posexplode_outer("hits").alias("rank", "hit"))
    return found.select("_q", (F.col("rank") + 1).alias("rank"), "hit.ref_id", "hit.dist")


@dataclass(frozen=True)
class Cells:
    """Pivots of the reference set with the extent of the cell around each."""

    pivots: np.ndarray
    count: np.ndarray
    near: np.ndarray  # smallest pivot distance in the cell
    far: np.ndarray  # largest pivot distance in the cell
    # Per cell the k smallest (nearest search) or largest (farthest search) pivot distances.
    edge: np.ndarray

    def lower_bounds(self, x: np.ndarray, d: np.ndarray) -> np.ndarray:
        """No point of a cell is closer to the row than this."""
        lower = np.maximum(np.maximum(d - self.far, self.near - d), 0.0)
        # A point of cell c is closer to pivot c than to the row's own pivot.
        own = d.argmin(1)
        gap = np.sqrt(sq_dists(self.pivots, self.pivots))[own]
        own_d = d[np.arange(len(x)), own]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d * d - (own_d * own_d)[:, None]) / (2.0 * gap)
        return np.maximum(np.maximum(lower, np.where(gap > 1e-9, plane, 0.0)) - 1e-6 * (1.0 + d), 0.0)

    def within(self, x: np.ndarray, radius: float) -> np.ndarray:
        """Boolean (rows, cells): the cells that can hold a point within the radius."""
        return self.lower_bounds(x, np.sqrt(sq_dists(x, self.pivots))) <= radius

    def candidates(self, x: np.ndarray, k: int, farthest: bool, epsilon: float, greedy: bool, tau: float) -> np.ndarray:
        """Boolean (rows, cells): the cells that can hold one of the k neighbours."""
        d = np.sqrt(sq_dists(x, self.pivots))
        if farthest:
            bound = np.abs(d[:, :, None] - self.edge[None])
            bound = np.where(np.isnan(bound), -np.inf, bound).reshape(len(x), -1)
            witness = np.argpartition(-bound, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(bound, witness, axis=1).min(1)
            must = (d + self.far + 1e-6 * (1.0 + d)) * (1.0 - epsilon) >= best[:, None]
            order = np.argsort(-(d + self.far), axis=1, kind="stable")
        else:
            bound = d[:, :, None] + self.edge[None]
            bound = np.where(np.isnan(bound), np.inf, bound).reshape(len(x), -1)
            witness = np.argpartition(bound, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(bound, witness, axis=1).max(1)
            must = self.lower_bounds(x, d) * (1.0 + epsilon) <= best[:, None]
            order = np.argsort(d, axis=1, kind="stable")
        # The points behind the bound are visited themselves, however large epsilon is.
        np.put_along_axis(must, witness // k, True, axis=1)
        if not greedy:
            return must
        # Greedy: only the most promising cells that together hold k points, widened by tau.
        held = np.cumsum(self.count[order], axis=1)
        needed = np.empty_like(must)
        np.put_along_axis(needed, order, (held - self.count[order]) < k, axis=1)
        if tau > 0 and not farthest:
            needed |= d - d.min(1)[:, None] <= 2.0 * tau
        return needed


def _assign(points: DataFrame, pivots: np.ndarray, column: str) -> DataFrame:
    @F.arrow_udf("struct<cell:int,pd:double>")
    def assign(x: pa.Array) -> pa.Array:
        m = to_matrix(x)
        idx, dist = nearest(m, pivots) if len(m) else (np.empty(0), np.empty(0))
        return pa.StructArray.from_arrays([pa.array(idx.astype(np.int32)), pa.array(np.sqrt(dist))], names=["cell", "pd"])

    return points.withColumn("_c", assign(column)).withColumn("cell", F.col("_c.cell")).withColumn("pd", F.col("_c.pd")).drop("_c")


def fit_cells(ref: DataFrame, n: int, k: int, farthest: bool = False, n_pivots: int | None = None, seed: int = 0) -> tuple[Cells, DataFrame]:
    """Cut (_ref, _rx, ...) into cells; the placed table is written once and read by every later step."""
    # The bounds of all cells together stay below a million numbers.
    want = n_pivots or max(1, min(MAX_PIVOTS, int(np.sqrt(n / 64.0)), 1_000_000 // k))
    drawn = to_matrix(sample_rows(ref.select("_ref", "_rx"), want, "_ref", seed).select("_rx").toArrow()["_rx"])
    pivots = np.unique(drawn, axis=0)
    placed = cut_lineage(_assign(ref, pivots, "_rx"))
    edge_order = F.col("pd").desc() if farthest else F.col("pd").asc()
    by_cell = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("pd").alias("near"), F.max("pd").alias("far"))
    ranked = placed.select("cell", "pd", F.row_number().over(W.partitionBy("cell").orderBy(edge_order, "_ref")).alias("r"))
    p = len(pivots)
    # A pivot whose cell is empty keeps near = inf, so no row is routed to it.
    cells = Cells(pivots, np.zeros(p), np.full(p, np.inf), np.full(p, -np.inf), np.full((p, k), np.nan))
    for row in by_cell.collect():
        c = row["cell"]
        cells.count[c], cells.near[c], cells.far[c] = row["n"], row["near"], row["far"]
    for row in ranked.filter(F.col("r") <= k).collect():
        cells.edge[row["cell"], row["r"] - 1] = row["pd"]
    return cells, placed


def _by_cell(values: np.ndarray) -> Column:
    """Per-cell integer as an expression of the ``cell`` column."""
    return F.get(F.array(*[F.lit(int(v)) for v in values]), F.col("cell"))


def block_join(
    query: DataFrame,
    placed: DataFrame,
    cells: Cells,
    visit: Callable[[np.ndarray], np.ndarray],
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    block_rows: int,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Meet each query with the reference points of the cells it visits, block by block.

    ``visit`` marks the cells per query row; ``work`` sees one block of queries and one
    block of reference points of one cell, each of about ``block_rows`` rows at most.
    """

    @F.arrow_udf("array<int>")
    def route(x: pa.Array) -> pa.Array:
        m = to_matrix(x)
        if len(m) == 0:
            return pa.array([], type=pa.list_(pa.int32()))
        parts, sizes = [], []
        for s in row_slices(len(m), cells.edge.size + len(cells.pivots) * 4):
            must = visit(m[s]) & (cells.count > 0)
            sizes.append(must.sum(1))
            parts.append(np.nonzero(must)[1])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32)))

    routed = query.withColumn("cell", F.explode(route("_qx")))
    load = np.zeros(len(cells.pivots), dtype=np.int64)
    for row in routed.groupBy("cell").count().collect():
        load[row["cell"]] = row["count"]
    ref_blocks = np.maximum(1, -(-cells.count.astype(np.int64) // block_rows))
    query_blocks = np.maximum(1, -(-load // block_rows))
    left = routed.withColumn("qb", F.pmod(row_hash(F.col("_q"), 11), _by_cell(query_blocks)).cast("int")).withColumn(
        "rb", F.explode(F.sequence(F.lit(0), _by_cell(ref_blocks) - 1))
    )
    right = placed.withColumn("rb", F.pmod(row_hash(F.col("_ref"), 13), _by_cell(ref_blocks)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), _by_cell(query_blocks) - 1))
    )
    keys = ["cell", "qb", "rb"]

    def block(qs: pa.Table, rs: pa.Table) -> pa.Table:
        return work(qs, rs)

    return (
        left.select(*keys, "_q", "_qx")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "_ref", "_rx", *extra).groupBy(*keys))
        .applyInArrow(block, schema)
    )


def _blocked(
    query: DataFrame,
    ref: DataFrame,
    n: int,
    k: int,
    farthest: bool,
    exclude_self: bool,
    *,
    epsilon: float,
    greedy: bool,
    tau: float,
    block_rows: int,
    n_pivots: int | None,
    seed: int,
) -> DataFrame:
    keep, k = k, k + exclude_self
    copies = F.row_number().over(W.partitionBy("_rx").orderBy("_ref"))
    distinct = ref.withColumn("_copy", copies).filter(F.col("_copy") <= k).drop("_copy")
    cells, placed = fit_cells(distinct, n, k, farthest, n_pivots, seed)
    nothing = pa.table({"_q": pa.array([], pa.int64()), "ref_id": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())})

    def work(qs: pa.Table, rs: pa.Table) -> pa.Table:
        if qs.num_rows == 0 or rs.num_rows == 0:
            return nothing
        ids = rs["_ref"].to_numpy()
        order = np.argsort(ids, kind="stable")
        found, dist = top_k(to_matrix(qs["_qx"]), to_matrix(rs["_rx"])[order], ids[order], k, farthest)
        return pa.table(
            {"_q": np.repeat(qs["_q"].to_numpy(), found.shape[1]), "ref_id": found.reshape(-1), "dist": dist.reshape(-1)}
        )

    def visit(x: np.ndarray) -> np.ndarray:
        return cells.candidates(x, k, farthest, epsilon, greedy, tau)

    partial = block_join(query, placed, cells, visit, work, "_q bigint, ref_id bigint, dist double", block_rows)
    return _best_of(partial, keep, farthest, exclude_self)


#: Reference rows that tell whether cells exclude anything, the cells they are cut into, and the share of cells that is too much.
TRIAL_ROWS, TRIAL_CELLS, TRIAL_SHARE = 4096, 64, 0.5


def _cells_exclude(ref: DataFrame, k: int, farthest: bool, seed: int) -> bool:
    """Whether a query visits less than TRIAL_SHARE of the cells of a drawn part of the reference set."""
    x = to_matrix(sample_rows(ref.select("_ref", "_rx"), TRIAL_ROWS, "_ref", seed).select("_rx").toArrow()["_rx"])
    pivots = np.unique(x[:: max(1, len(x) // TRIAL_CELLS)], axis=0)
    if not np.isfinite(x).all() or len(x) < k:
        return True
    own, sq = nearest(x, pivots)
    away, p = np.sqrt(sq), len(pivots)
    cells = Cells(pivots, np.bincount(own, minlength=p).astype(float), np.full(p, np.inf), np.full(p, -np.inf), np.full((p, k), np.nan))
    for c in range(p):
        d = np.sort(away[own == c])
        if len(d):
            cells.near[c], cells.far[c] = d[0], d[-1]
            best = (d[::-1] if farthest else d)[:k]
            cells.edge[c, : len(best)] = best
    seen = [cells.candidates(x[s], k, farthest, 0.0, False, 0.0)[:, cells.count > 0].mean(1) for s in row_slices(len(x), p * (k + 4))]
    return float(np.concatenate(seen).mean()) < TRIAL_SHARE


def _packed_rows(side: DataFrame, rows: int) -> DataFrame:
    """(ids, x) of about ``rows`` rows of a partition each, by rising id; x is the bytes of their matrix."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            table = table.take(pa.array(np.argsort(table[0].to_numpy(), kind="stable")))
            ids = table[0].combine_chunks()
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_arrays([ids, pa.array([to_matrix(table[1]).tobytes()], pa.binary())], ["ids", "x"])

        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                held.append(batch.slice(lo, rows))
                if sum(b.num_rows for b in held) >= rows:
                    yield block()
                    held = []
        if held:
            yield block()

    return side.mapInArrow(pack, "ids array<bigint>, x binary")


def _multiplied(query: DataFrame, ref: DataFrame, n: int, dim: int, k: int, farthest: bool, exclude_self: bool, block_rows: int) -> DataFrame:
    """Every block of queries meets every block of the reference set; neither is shuffled.

    Blocks of the reference set are as large as what is sent to the tasks otherwise, so a query has k candidates of each of few.
    """
    keep, k = k, k + exclude_self
    chunk = max(1, BROADCAST_BYTES // (8 * dim + 8))
    blocks = max(1, -(-n // chunk))
    spread = ref.select("_ref", "_rx")
    spread = spread.coalesce(blocks) if spread.rdd.getNumPartitions() > blocks else spread
    points = cut_lineage(_packed_rows(spread, chunk)).withColumnsRenamed({"ids": "rids", "x": "rx"})
    cores = query.sparkSession.sparkContext.defaultParallelism
    asked = query.select("_q", "_qx")
    if asked.rdd.getNumPartitions() * blocks < cores:
        asked = asked.repartition(cores, "_q")
    asked = _packed_rows(asked, block_rows).withColumnsRenamed({"ids": "qids", "x": "qx"})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, ids = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (0, 2))
                x, r = (np.frombuffer(batch.column(c)[i].as_buffer(), float).reshape(len(v), -1) for c, v in ((1, q), (3, ids)))
                found, dist = top_k(x, r, ids, k, farthest)
                for s in row_slices(len(q), found.shape[1], 1 << 18):
                    columns = [np.repeat(q[s], found.shape[1]), found[s].reshape(-1), dist[s].reshape(-1)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_q", "ref_id", "dist"])

    met = asked.hint("shuffle_replicate_nl").crossJoin(points).select("qids", "qx", "rids", "rx")
    return _best_of(met.mapInArrow(search, "_q bigint, ref_id bigint, dist double"), keep, farthest, exclude_self)


def _best_of(partial: DataFrame, k: int, farthest: bool, exclude_self: bool) -> DataFrame:
    if exclude_self:
        partial = partial.filter(F.col("_q") != F.col("ref_id"))
    better = F.col("dist").desc() if farthest else F.col("dist").asc()
    rank = F.row_number().over(W.partitionBy("_q").orderBy(better, "ref_id"))
    return partial.withColumn("rank", rank).filter(F.col("rank") <= k).select("_q", "rank", "ref_id", "dist")


def neighbour_join(
    query: DataFrame,
    ref: DataFrame,
    k: int = 1,
    *,
    query_id: str = "row_id",
    ref_id: str = "row_id",
    query_features: str = "features",
    ref_features: str = "features",
    farthest: bool = False,
    epsilon: float = 0.0,
    greedy: bool = False,
    tau: float = 0.0,
    exclude_self: bool = False,
    strategy: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int | None = None,
    n_pivots: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """(query_id, rank, ref_id, dist): the k best reference rows of each query, ties by lower id.

    ``epsilon`` allows a relative error of the returned distances (a cell is skipped
    when it could improve them by less), ``greedy`` visits only the most promising
    cells, ``tau`` widens that visit.  ``block_rows`` is the size of blocks of a small
    table, those of a large one grow up to about 16 MB.  ``exclude_self`` drops the pair of equal ids,
    for a table joined with itself.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    n, dim = shape(ref, ref_features)
    if k + exclude_self > n:
        raise ValueError(f"k = {k} neighbours asked of {n - exclude_self} reference points")
    q = query.select(F.col(query_id).cast("bigint").alias("_q"), F.col(query_features).cast("array<double>").alias("_qx"))
    r = ref.select(F.col(ref_id).cast("bigint").alias("_ref"), F.col(ref_features).cast("array<double>").alias("_rx"))
    size = n * (dim * 8 + 8)
    if strategy == "auto":
        strategy = "blocks" if size > broadcast_bytes or epsilon > 0 or greedy else "broadcast"
        if strategy == "blocks" and not (epsilon > 0 or greedy) and not _cells_exclude(r, k + exclude_self, farthest, seed):
            strategy = "products"
    if strategy == "broadcast":
        if size > broadcast_bytes:
            raise ValueError(f"reference set of {size} bytes exceeds the broadcast limit {broadcast_bytes}")
        out = _small_reference(q, r, k, farthest, exclude_self)
    elif strategy == "products":
        out = _multiplied(q, r, n, dim, k, farthest, exclude_self, block_rows or block_rows_of(dim))
    else:
        # A block of b rows is copied n / b times: blocks of a fixed size would be exchanged in proportion to the square of n.
        widest = block_rows_of(dim)
        block_rows = max(block_rows or widest, min(widest, n // BLOCK_COPIES))
        out = _blocked(
            q, r, n, k, farthest, exclude_self,
            epsilon=epsilon, greedy=greedy, tau=tau, block_rows=block_rows, n_pivots=n_pivots, seed=seed,
        )
    return out.select(F.col("_q").alias("query_id"), "rank", "ref_id", "dist")


def knn(query: DataFrame, ref: DataFrame, k: int = 1, **options: object) -> DataFrame:
    """k nearest neighbours."""
    return neighbour_join(query, ref, k, **options)


def kfn(query: DataFrame, ref: DataFrame, k: int = 1, *, percentage: float = 1.0, **options: object) -> DataFrame:
    """k farthest neighbours; ``percentage`` p < 1 accepts p of the true farthest distance."""
    if not 0.0 < percentage <= 1.0:
        raise ValueError("percentage lies in (0, 1]")
    return neighbour_join(query, ref, k, farthest=True, epsilon=1.0 - percentage, **options)


@dataclass(frozen=True)
class NeighbourSearch:
    """A reference table (row_id, features) with the options of a search, as a model that can be kept."""

    reference: DataFrame
    options: dict[str, object]

    def search(self, query: DataFrame, k: int = 1, **more: object) -> DataFrame:
        return neighbour_join(query, self.reference, k, **{**self.options, **more})


def best_match(df: DataFrame, codebook: np.ndarray, features_col: str = "features", output_col: str = "bmu") -> DataFrame:
    """Index and squared distance of the nearest codebook row; the first one wins ties."""

    @F.arrow_udf("struct<node:int,sq_dist:double>")
    def match(x: pa.Array) -> pa.Array:
        m = to_matrix(x)
        idx, dist = nearest(m, codebook) if len(m) else (np.empty(0), np.empty(0))
        return pa.StructArray.from_arrays([pa.array(idx.astype(np.int32)), pa.array(dist)], names=["node", "sq_dist"])

    return df.withColumn(output_col, match(features_col))


__all__ = ["NeighbourSearch", "best_match", "kfn", "knn", "neighbour_join"]
