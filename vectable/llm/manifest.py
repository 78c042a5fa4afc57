"""A Merkle tree over the rows of a table, a proof for every row, and the check of what a reader holds against it."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.operators.order import sequence_position
from vectable.session import cut_lineage

#: Levels of the tree that one superblock takes in: its groups have 2**10 nodes.
SPAN = 10
ABSENT = "-"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, a colon, and the value."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit(ABSENT))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def levels_of(nodes: list[str], alone: bool, span: int) -> list[list[str]]:
    """The nodes of a block and of every level above them.

    Two neighbours become their digest, a last one without a neighbour its
    own.  A block that is alone in its tree ends with one node; another one
    goes on to the height of a whole block.
    """
    levels = [nodes]
    while len(levels[-1]) > 1 or (not alone and len(levels) <= span):
        below = levels[-1]
        levels.append([digest(below[k] + below[k + 1] if k + 1 < len(below) else below[k]) for k in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], k: int) -> list[str]:
    """What stands beside the way from node k to the top: `<` and a node on the left, `>` and one on the right, or nothing."""
    out = []
    for level in levels[:-1]:
        other = k ^ 1
        out.append(("<" if other < k else ">") + level[other] if other < len(level) else "")
        k >>= 1
    return out


def folded(node: str, way: Sequence[str]) -> str:
    """The top that a node leads to beside the given siblings."""
    for s in way:
        node = digest(s[1:] + node if s[:1] == "<" else node + s[1:])
    return node


def is_alone(block: int, n: int, span: int) -> bool:
    """Blocks fill up in order: a first block that is not full is the only one of its tree; a full one has a single top either way."""
    return block == 0 and n < 1 << span


def tops(nodes: DataFrame, span: int) -> DataFrame:
    """(tree, idx, node): the top of every superblock of nodes (tree, idx, node), numbered in order."""

    def work(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        hexes = [bytes(n).hex() for n in block.sort_values("idx")["node"]]
        top = levels_of(hexes, is_alone(key[1], len(hexes), span), span)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "node": [bytes.fromhex(top)]})

    blocks = nodes.select("tree", F.shiftright("idx", span).alias("block"), "idx", "node")
    return blocks.groupBy("tree", "block").applyInPandas(work, "tree string, idx bigint, node binary")


def climb(nodes: DataFrame, span: int) -> list[DataFrame]:
    """Nodes, the tops of their superblocks, the tops of those, and so on until every tree has one."""
    rounds = [nodes]
    while not rounds[-1].where("idx > 0").isEmpty():
        rounds.append(cut_lineage(tops(rounds[-1], span)))
    return rounds


def descend(nodes: DataFrame, outer: DataFrame, span: int) -> DataFrame:
    """(tree, idx, way, subroot, root) of nodes, from the same of the tops of their superblocks."""

    def work(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        levels = levels_of([bytes(n).hex() for n in block["node"]], is_alone(key[1], len(block), span), span)
        way = list(above["way"].iloc[0])
        ways = [siblings(levels, k) + way for k in range(len(block))]
        return pd.DataFrame({"tree": key[0], "idx": block["idx"], "way": ways, "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})

    blocks = nodes.select("tree", F.shiftright("idx", span).alias("block"), "idx", "node").groupBy("tree", "block")
    above = outer.withColumnRenamed("idx", "block").groupBy("tree", "block")
    return blocks.cogroup(above).applyInPandas(work, "tree string, idx bigint, way array<string>, subroot binary, root binary")


def outer_nodes(rounds: list[DataFrame], top: DataFrame, span: int) -> DataFrame:
    """The ways of the first superblocks of a tree: the nodes outside them that their leaves need."""
    outer = top
    for nodes in reversed(rounds[1:-1]):
        outer = cut_lineage(descend(nodes, outer, span))
    return outer


def finish(leaves: DataFrame, outer: DataFrame, span: int, proofs: bool) -> DataFrame:
    """Leaves and the outer nodes of their superblock: the block is reduced, proofs are joined, and what was seen is folded."""

    def work(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        hexes = [bytes(n).hex() for n in block["node"]]
        levels = levels_of(hexes, is_alone(key[1], len(block), span), span)
        way = list(above["way"].iloc[0])
        beside = "".join(s[1:] for s in way)
        subroot, root = (bytes(above[c].iloc[0]).hex() for c in ("subroot", "root"))
        reached: dict[str, str] = {}
        proof, end, full = [], [], []
        for k, (leaf, seen) in enumerate(zip(hexes, block["seen"])):
            inner = siblings(levels, k)
            proof.append(digest("".join(s[1:] for s in inner) + beside))
            top = folded(leaf if seen is None else bytes(seen).hex(), inner)
            if top not in reached:
                reached[top] = folded(top, way)
            end.append(reached[top])
            if proofs:
                full.append(inner + way)
        out = {"id": block["id"], "leaf": hexes, "subroot": subroot, "root": root, "proof_sha256": proof, "folded_root": end, "verified": np.array(end) == root}
        return pd.DataFrame(out | ({"proof": full} if proofs else {}))

    blocks = leaves.withColumn("block", F.shiftright("idx", span)).groupBy("tree", "block")
    above = outer.withColumnRenamed("idx", "block").groupBy("tree", "block")
    more = ", proof array<string>" if proofs else ""
    return blocks.cogroup(above).applyInPandas(work, f"id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean{more}")


def manifest(df: DataFrame, columns: Sequence[str], id_col: str = "doc_id", group: str = "lang", seen: dict[str, Column] | None = None, span: int = SPAN, proofs: bool = False) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of df.

    A row is a leaf: the SHA-256 of its `columns`, each `-` if NULL, else its
    length in bytes, a colon and its value.  The leaves of a group ascend by
    id (NULL first, equal ids by leaf; equal rows take any order among
    themselves).  Two neighbours become their digest, a last single one its own, until one
    is left: the subroot.  NULL is a group of its own, the first one; groups
    ascend by UTF-8 bytes, and their subroots become the root in the same
    way.  A proof is the siblings on the way to the root, from the bottom;
    proof_sha256 is the digest of them joined, that of nothing if there are none.
    `seen` gives the values that a reader holds for some columns: folded_root
    is what the reader's leaf leads to beside the siblings of the manifest, and verified whether it is the root.
    With `proofs`, the column proof has the siblings, `<` or `>` before each
    for its side, and an empty string where there is none.  A table without
    rows has no tree and no rows.

    Texts are read once, for the leaves; then only digests move.  Positions
    come from a range partitioning, so a group may hold any share of the rows.  A
    superblock has 1024 leaves: its top goes up, the nodes outside of it come
    back, and both meet its leaves in one cogroup.  Every round leaves a
    1024th of the nodes, and there is one round more for each factor of 1024 in the rows of a group.
    """
    if not 1 <= span <= 20:
        raise ValueError("span is 1 to 20")
    kind = df.schema[id_col].dataType.simpleString()
    values = [F.col(c) for c in columns]
    held = leaf_digest([(seen or {}).get(c, F.col(c)) for c in columns])
    own = leaf_digest(values)
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree")
    read = df.select(tree, F.col(id_col).alias("id"), own.alias("own"), held.alias("held"))
    read = read.select("tree", "id", F.unhex("own").alias("node"), F.when(F.col("own") != F.col("held"), F.unhex("held")).alias("seen"))
    # Equal rows need an order as well, and one that a second reading keeps.
    fixed = cut_lineage(read).withColumn("row", F.monotonically_increasing_id())
    leaves = sequence_position(fixed, ["tree"], ["id", "node", "row"], "idx").select("tree", "idx", F.col("id").cast("string").alias("id"), "node", "seen")

    rounds = climb(leaves, span)
    if len(rounds) == 1:
        rounds.append(cut_lineage(tops(leaves, span)))
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("node"))
    placed = cut_lineage(sequence_position(subroots, ["tree"], ["of"], "idx"))
    above = climb(placed.select("tree", "idx", "node"), span)
    if len(above) == 1:
        above.append(cut_lineage(tops(placed.select("tree", "idx", "node"), span)))
    peak = above[-1].select("tree", "idx", F.array().cast("array<string>").alias("way"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    ways = descend(above[0], outer_nodes(above, peak, span), span)
    top = placed.join(ways.select("idx", "way", "root"), "idx").select(F.col("of").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "way", F.col("node").alias("subroot"), "root")
    done = finish(leaves, outer_nodes(rounds, cut_lineage(top), span), span, proofs)
    return done.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
