"""Near-duplicate vectors by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm import rows
from vectable.llm.graph import components, roots
from vectable.session import cut_lineage

COSINE = 0.93
TABLES = 5
HASHES = 2
PROBES = 3
BLOCK_ROWS = 1024
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, of unit scale."""
    n, width = x.shape
    x = x.copy()
    h = 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def rotation_signs(width: int, tables: int, hashes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).choice((-1.0, 1.0), (tables, hashes, 3, width))


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """A pseudo-random rotation: three rounds of random signs and a Hadamard transform."""
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Bucket codes (row, table, probe) of unit vectors; probe 0 is the bucket a vector is at home in.

    A hash is the nearest of the 2d signed axes after a rotation, a bucket
    `hashes` of them.  Further probes replace the axis of one or two hashes by the next
    nearest ones, in the order of what that gives away.
    """
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    if (2 * width) ** hashes >= 1 << 31:
        raise ValueError("a bucket code has to fit 31 bits: take fewer hashes")
    x = np.pad(x, ((0, 0), (0, width - d)))
    signs = rotation_signs(width, tables, hashes, seed)
    ranks = min(3, width)
    choices = [c for c in np.ndindex(*[ranks] * hashes)]
    out = np.empty((n, tables, 1 + probes), np.int64)
    for t in range(tables):
        axis, loss = [], []
        for k in range(hashes):
            y = rotated(x, signs[t, k])
            top = np.argsort(-np.abs(y), 1, kind="stable")[:, :ranks]
            v = np.take_along_axis(y, top, 1)
            axis.append(2 * top + (v < 0))
            loss.append(np.abs(v[:, :1]) - np.abs(v))
        total = np.stack([sum(loss[k][:, c[k]] for k in range(hashes)) for c in choices], 1)
        code = np.zeros((n, len(choices)), np.int64)
        for k in range(hashes):
            code = code * (2 * width) + axis[k][:, [c[k] for c in choices]]
        order = np.argsort(total, 1, kind="stable")[:, : 1 + probes]
        out[:, t] = np.take_along_axis(code, order, 1)
    return out


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    # Scaling first keeps squares of very large and very small components finite.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of codes: (table, bucket) of the first place where both are and one is at home, as one number."""
    n, tables, probes = a.shape
    best = np.full(n, np.iinfo(np.int64).max)
    for t in reversed(range(tables)):
        here = np.full(n, np.iinfo(np.int64).max)
        for i in range(probes):
            for j in range(probes):
                if i == 0 or j == 0:
                    here = np.minimum(here, np.where(a[:, t, i] == b[:, t, j], a[:, t, i], np.iinfo(np.int64).max))
        best = np.where(here < np.iinfo(np.int64).max, here * tables + t, best)
    return best


def bucket_links(group: pa.Table, tables: int, probes: int, cosine: float, kind: type) -> pa.RecordBatch | None:
    """Per vector of one block of a bucket: how many vectors it links with here, and the least node it can reach.

    A pair counts in the first of all buckets it meets in, and nowhere else.
    """
    home = group["home"].to_numpy(zero_copy_only=False)
    if not home.any():
        return None
    node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
    n = len(node)
    x = unit_rows(np.frombuffer(b"".join(group["vector"].to_pylist()), kind).reshape(n, -1))
    codes = np.frombuffer(b"".join(group["codes"].to_pylist()), np.int32).reshape(n, tables, 1 + probes).astype(np.int64)
    part = group["part"].to_numpy()
    lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
    here = group["code"][0].as_py() * tables + group["table"][0].as_py()
    first = np.flatnonzero(part == lo)
    second = np.flatnonzero(part == hi)
    if lo == hi:
        sides = [(first[home[first]], first[home[first]]), (first[home[first]], first[~home[first]])]
    else:
        sides = [(first[home[first]], second), (first[~home[first]], second[home[second]])]
    links, root = np.zeros(n, np.int64), np.arange(n)
    for k, (a, b) in enumerate(sides):
        step = max(1, (1 << 19) // max(1, len(b)))
        for at in range(0, len(a), step):
            i, j = np.nonzero(x[a[at : at + step]] @ x[b].T >= cosine)
            i, j = a[at + i], b[j]
            if lo == hi and k == 0:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 1 << 16):
                p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                new = first_meeting(codes[p], codes[q]) == here
                p, q = p[new], q[new]
                if len(p):
                    links += np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
                    root = roots(n, np.concatenate((np.arange(n), p)), np.concatenate((root, q)))
    some = np.flatnonzero(links)
    if not len(some):
        return None
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])], ["node", "links", "root"])


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str | None = "label", cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of df.

    Vectors of equal label and length link if their cosine, in double
    precision, is at least `cosine` and hashing brings them together; both
    directions of a link count.  Vectors that are NULL, zero or have NULL or
    non-finite components, and rows with a NULL label, link with nothing and
    are their own component.  component_id is the least id reachable; kept
    says whether it is the row's own (false without an id).

    Equal vectors are one node with a number of copies, so copies are never
    paired.  Buckets are compared in blocks of bounded size, and only sums
    and a spanning forest leave a block.
    """
    same = F.col(label) if label else F.lit(0)
    number = np.float32 if df.schema[vector].dataType.simpleString() == "array<float>" else np.float64
    values = F.col(vector).cast("array<double>")
    whole = F.size(vector) > 0
    good = same.isNotNull() & F.col(vector).isNotNull() & whole & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(values, lambda v: v != 0)
    marked = df.select(F.col(id_col).alias("id"), same.alias("label"), values.alias("vector"), F.coalesce(good, F.lit(False)).alias("good"))
    nodes = marked.where("good").groupBy("label", "vector").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    nodes = cut_lineage(nodes).withColumn("node", F.monotonically_increasing_id())
    kind = dict(nodes.dtypes)["label"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(1).to_pylist()], np.int64) if batch.num_rows else np.empty(0, np.int64)
            for d in np.unique(sizes).tolist():
                of_size = np.flatnonzero(sizes == d)
                for at in range(0, len(of_size), 512):
                    part = batch.take(pa.array(of_size[at : at + 512]))
                    raw = np.array(part.column(1).to_pylist(), np.float64)
                    codes = buckets(unit_rows(raw), tables, hashes, probes)
                    n = len(raw)
                    row = np.repeat(np.arange(n), tables * (1 + probes))
                    pick = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pick), pa.array(np.full(len(row), d, np.int32)), pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + probes), n)), pa.array(codes.reshape(-1)),
                            pa.array(np.tile(np.arange(1 + probes) == 0, n * tables)), part.column(2).take(pick), part.column(3).take(pick),
                            pa.array([v.tobytes() for v in raw.astype(number)], pa.binary()).take(pick), pa.array([c.tobytes() for c in codes.astype(np.int32)], pa.binary()).take(pick),
                        ],
                        ["label", "size", "table", "code", "home", "node", "copies", "vector", "codes"],
                    )

    members = nodes.select("label", "vector", "node", "copies").mapInArrow(route, f"label {kind}, size int, table int, code bigint, home boolean, node bigint, copies bigint, vector binary, codes binary")
    keys = ["label", "size", "table", "code"]
    blocks = rows.in_blocks(members, keys, F.xxhash64("node"), BLOCK_ROWS)
    found = cut_lineage(rows.by_group(blocks, [*keys, "lo", "hi"], lambda g: bucket_links(g, tables, probes, cosine, number), "node bigint, links bigint, root bigint"))

    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = cut_lineage(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()))
    ids = nodes.select("node", "first_id")
    least = cut_lineage(joined.join(ids, "node").groupBy("root").agg(F.min("first_id").alias("least_id")))
    component = joined.join(least, "root").select("node", "least_id")
    named = nodes.join(counted, "node", "left").join(component, "node", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least_id", "first_id").alias("component_id")
    )
    named = cut_lineage(named.withColumn("good", F.lit(True)))
    out = marked.join(named, ["label", "vector", "good"], "left")
    component_id = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component_id.alias("component_id"), F.coalesce(F.col("id") == component_id, F.lit(False)).alias("kept"))
