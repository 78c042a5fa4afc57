"""Near-duplicates by 64-bit SimHash, found with a vantage-point tree over Hamming distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm import rows
from vectable.llm.graph import components, roots
from vectable.session import cut_lineage

SHINGLE = 3
SEED = 42
RADIUS = 3
SHARD_ROWS = 8192
BLOCK_ROWS = 32768
SAMPLE = 4096
PIVOT_CANDIDATES = 24
#: Two fingerprints at distance 3 or less are at distance 1 or less in one of these halves.
HALVES = (0xFFFFFFFF00000000, 0x00000000FFFFFFFF)


def fingerprint(text: bytes) -> int:
    """Bits set in over half of the XXH64 values of the text's 3-word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(words, words[1:], words[2:])), np.uint64, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        part = h[lo : lo + (1 << 16)]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(len(part), 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every whole text as a signed 64-bit number.  A NULL text has none of its words, so 0."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.empty(batch.num_rows, np.uint64)
            for s in rows.slices(batch.column(1)):
                for k in range(s.last - s.first):
                    fps[s.first + k] = fingerprint(s.data[s.offsets[k] : s.offsets[k + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows.signed(fps))], [id_col, "fp"])

    return df.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


class Tree:
    """A vantage-point tree over the bits of a mask, of fixed height, with one vantage point a level.

    A fingerprint goes to the far side of a level if its distance to the
    vantage point is over the level's radius; the sides taken give its shard.
    By the triangle inequality a fingerprint within `reach` of it can be on
    the other side only if the distance is within `reach` of the radius, so
    only such levels are followed on both sides.
    """

    def __init__(self, sample: np.ndarray, levels: int, mask: int, reach: int, seed: int = 7) -> None:
        self.mask, self.reach = np.uint64(mask), reach
        rng = np.random.default_rng(seed)
        pivots, radii = [], []
        for _ in range(levels):
            candidates = rng.integers(0, 1 << 64, PIVOT_CANDIDATES, np.uint64, endpoint=False)
            best = None
            for p in candidates:
                d = self.distance(sample, p)
                for r in np.unique(np.quantile(d, (0.4, 0.5, 0.6)).astype(int)):
                    near = float((d <= r).mean())
                    both = float((np.abs(d - r - 0.5) < reach).mean())
                    # Share of pairs left times what is looked up twice.
                    cost = (near * near + (1 - near) ** 2) * (1 + both)
                    if best is None or cost < best[0]:
                        best = (cost, p, int(r))
            pivots.append(best[1])
            radii.append(best[2])
        self.pivots, self.radii = np.array(pivots, np.uint64), radii

    def distance(self, fp: np.ndarray, pivot: np.uint64) -> np.ndarray:
        return np.bitwise_count((fp ^ pivot) & self.mask).astype(np.int64)

    def home(self, fp: np.ndarray) -> np.ndarray:
        shard = np.zeros(len(fp), np.int64)
        for level, (p, r) in enumerate(zip(self.pivots, self.radii)):
            shard |= (self.distance(fp, p) > r).astype(np.int64) << level
        return shard

    def visits(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) for every shard that may hold something within reach of a row."""
        row, shard = np.arange(len(fp)), np.zeros(len(fp), np.int64)
        for level, (p, r) in enumerate(zip(self.pivots, self.radii)):
            d = self.distance(fp, p)[row]
            near, far = d - self.reach <= r, d + self.reach > r
            row, shard = np.concatenate((row[near], row[far])), np.concatenate((shard[near], shard[far] | (1 << level)))
        return row, shard


def near_pairs(a: np.ndarray, b: np.ndarray, reach: int, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a and b at Hamming distance up to reach; each pair once if a is b."""
    step = max(1, (1 << 20) // max(1, len(b)))
    for lo in range(0, len(a), step):
        rest = lo if within else 0
        close = np.bitwise_count(a[lo : lo + step, None] ^ b[None, rest:]) <= reach
        i, j = np.nonzero(close)
        i, j = i + lo, j + rest
        if within:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def shard_links(group: pa.Table, reach: int = RADIUS) -> pa.RecordBatch | None:
    """A spanning forest of the links inside one block of a shard: at most a link per fingerprint."""
    fp = group["fp"].to_numpy().view(np.uint64)
    home, part = group["home"].to_numpy(zero_copy_only=False), group["part"].to_numpy()
    lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
    first = np.flatnonzero(part == lo)
    second = first if lo == hi else np.flatnonzero(part == hi)
    root = np.arange(len(fp))
    sides = [(first[home[first]], second), (first[~home[first]], second[home[second]])] if lo != hi else [(first[home[first]], first[home[first]]), (first[home[first]], first[~home[first]])]
    for k, (a, b) in enumerate(sides):
        for i, j in near_pairs(fp[a], fp[b], reach, lo == hi and k == 0):
            root = roots(len(fp), np.concatenate((np.arange(len(fp)), a[i])), np.concatenate((root, b[j])))
    linked = np.flatnonzero(root != np.arange(len(fp)))
    if not len(linked):
        return None
    return pa.RecordBatch.from_arrays([pa.array(fp[linked].view(np.int64)), pa.array(fp[root[linked]].view(np.int64))], ["a", "b"])


def links(distinct: DataFrame, n: int, shard_rows: int = SHARD_ROWS, reach: int = RADIUS) -> DataFrame:
    """Links (a, b) between different fingerprints `fp` that span every component at distance up to `reach`.

    There is a tree over either half of the bits, searched up to half the
    distance: one of the halves of a pair is that near, and the smaller reach
    crosses far fewer boundaries than one tree over all bits would.  Vantage
    points are drawn, their radii set on a sample of about 4096 fingerprints;
    a tree is a handful of numbers.  Each fingerprint is at home in one shard
    and visits later shards across the boundaries that it is near to; shards
    are compared over all bits, in blocks of bounded size.
    """
    levels = max(0, int(np.ceil(np.log2(max(1, n) / shard_rows))))
    sample = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(n)) < SAMPLE) if n > SAMPLE else distinct
    seen = np.array([r[0] for r in sample.collect()], np.int64).view(np.uint64) if levels else np.empty(0, np.uint64)
    trees = [Tree(seen, levels, mask, reach // len(HALVES)) for mask in (HALVES if levels else HALVES[:1])]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(fp), 2048):
                part = fp[lo : lo + 2048]
                for k, tree in enumerate(trees):
                    row, shard = tree.visits(part)
                    own = tree.home(part)[row]
                    keep = shard >= own
                    row, shard, own = row[keep], shard[keep], own[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(len(trees) * shard + k), pa.array(part[row].view(np.int64)), pa.array(shard == own)], ["shard", "fp", "home"])

    members = distinct.select("fp").mapInArrow(route, "shard bigint, fp bigint, home boolean")
    blocks = rows.in_blocks(members, ["shard"], F.xxhash64("fp"), BLOCK_ROWS)
    return rows.by_group(blocks, ["shard", "lo", "hi"], lambda g: shard_links(g, reach), "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row of df.

    Rows link if their fingerprints differ in at most 3 bits; component_id is
    the smallest id reachable.  Equal fingerprints are one node.  NULL ids
    stay as rows but name no component: it is NULL if no member has an id.
    """
    prints = cut_lineage(fingerprints(df, id_col, text))
    classes = cut_lineage(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    found = cut_lineage(components(links(classes, classes.count())))
    named = cut_lineage(found.join(classes, found.node == classes.fp).groupBy("root").agg(F.min("first_id").alias("least_id")))
    linked = found.join(named, "root").select(F.col("node").alias("fp"), "least_id")
    whole = cut_lineage(classes.join(linked, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id")))
    return prints.join(whole, "fp", "left").select(id_col, "fp", "component_id")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df whose id is the smallest of its group of near-duplicates; all columns as they are.

    Rows that repeat such an id are one document: the one with the least text
    stays (NULL is the least; among equal texts the least by all columns as
    JSON).  Rows without an id stay.
    """
    groups = near_duplicates(df, id_col, text)
    found = groups.where(F.col(id_col) == F.col("component_id"))
    stay = cut_lineage(found.groupBy(F.col(id_col).alias("__stay")).agg(F.count("*").alias("__rows")))
    kept = df.join(stay.hint("shuffle_hash"), F.col(id_col) == F.col("__stay"))
    if not stay.where(F.col("__rows") > 1).isEmpty():
        whole = F.struct(*df.columns)
        least = F.min_by(whole, F.struct(F.col(text), F.to_json(whole))).alias("__least")
        first = kept.where(F.col("__rows") > 1).groupBy("__stay").agg(least).select("__least.*")
        kept = kept.where(F.col("__rows") == 1).select(*df.columns).unionByName(first)
    return kept.select(*df.columns).unionByName(df.where(F.col(id_col).isNull()))


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
