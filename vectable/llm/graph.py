"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.session import cut_lineage

CHUNK_LINKS = 1 << 20


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n local nodes and links (a, b): the smallest node each one can reach."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def contracted(links: DataFrame, parts: int) -> DataFrame:
    """Links (u, v) with the same components, from chunks that are solved by themselves: a star for each component of a chunk."""

    def solve(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(k).to_numpy() for x in batches]) for k in (0, 1))
        nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        root = roots(len(nodes), at[: len(a)], at[len(a) :])
        out = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[root[out]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= CHUNK_LINKS:
                yield solve(held)
                held = []
        if held:
            yield solve(held)

    return links.coalesce(parts).mapInArrow(run, "u bigint, v bigint")


def are_stars(links: DataFrame) -> bool:
    """Every u has one link, and no v is the u of another one."""
    centres = links.select(F.col("v").alias("u")).distinct()
    return links.groupBy("u").count().where("count > 1").isEmpty() and links.select("u").join(centres, "u", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), both bigint, where root is the smallest node it can reach.

    Links are first reduced in chunks of about a million to a forest, where
    they lie.  Those of several chunks are then rewired towards the smallest neighbour of either end, in turn
    over the larger and the smaller neighbours, until every component is a
    star.  No step gathers the neighbours of a node; the joins have plain
    exchanges on both sides, so that AQE splits the rows of a hub.
    """
    links = cut_lineage(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("a <> b"))
    parts = max(1, -(-links.count() // CHUNK_LINKS))
    links = cut_lineage(contracted(links, parts))
    while parts > 1 and not are_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        wide = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        wide = cut_lineage(wide)
        least = cut_lineage(wide.groupBy("u").agg(F.min("v").alias("m")))
        narrow = wide.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut_lineage(narrow.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
