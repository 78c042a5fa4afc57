"""Documents packed into training sequences of several permitted lengths by best fit."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)
SHARD_DOCS = 4096
#: Fixed cost of a sequence, and the length at which quadratic work costs as much as linear work.
OPENING = 32
QUADRATIC = 65536


def word_count(text: str) -> Column:
    """Words between runs of 0x20 and 0x09 to 0x0D; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def cost(capacity: int) -> float:
    return OPENING + capacity + capacity * capacity / QUADRATIC


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, price: Callable[[int], float] = cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every piece and the capacity of every bin.

    Pieces come longest first.  Each goes to the open bin that it leaves the
    least room in; without one, the size is opened whose price per token is
    least, given the tokens of the pieces to come that could fill the room.
    At the end every bin shrinks to the smallest capacity that holds it.
    """
    caps = np.array(sorted(capacities))
    top = int(caps[-1])
    waiting = np.bincount(lengths, minlength=top + 1) * np.arange(top + 1)
    room: list[list[int]] = [[] for _ in range(top + 1)]
    free = 0  # bit r is set if an open bin has room for r more tokens
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    size: list[int] = []
    used: list[int] = []
    for k, n in enumerate(lengths.tolist()):
        waiting[n] -= n
        fits = free >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free &= ~(1 << r)
        else:
            possible = caps[np.searchsorted(caps, n) :].tolist()
            b = len(size)
            r = min(possible, key=lambda c: (price(c) / (n + min(c - n, int(waiting[: c - n + 1].sum()))), c))
            size.append(r)
            used.append(0)
        bins[k], offsets[k] = b, used[b]
        used[b] += n
        left = r - n
        if left:
            room[left].append(b)
            free |= 1 << left
    return bins, offsets, caps[np.searchsorted(caps, np.array(used, np.int64))] if used else np.empty(0, np.int64)


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES, shard_docs: int = SHARD_DOCS, price: Callable[[int], float] = cost) -> DataFrame:
    """(id, piece, piece_start, n_tokens, bin_id, bin_offset, capacity): every document in sequences.

    Documents longer than the largest capacity are cut into pieces of that
    length and a rest; piece_start counts the tokens before a piece.
    `length` is the number of tokens, by default the number of words.
    Documents without a token (NULL, empty) have one piece of no tokens and
    no bin.  Repeated rows are packed once for each row.

    Rows are dealt by hash into shards of about `shard_docs` documents that
    are packed apart, so that a task holds lengths of one shard only; what
    this costs is at most a few half-full bins a shard.
    """
    top = max(capacities)
    measure = length if length is not None else word_count(text)
    shards = max(1, -(-docs.count() // shard_docs))
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.col(id_col)), F.lit(shards)).cast("bigint").alias("shard")
    sized = docs.select(F.col(id_col).alias("id"), measure.cast("bigint").alias("n"), deal)
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / top) - 1)
    cut = sized.select("id", "shard", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    pieces = cut.select("id", "shard", "piece", (F.col("piece") * top).alias("piece_start"), F.least(F.lit(top), F.col("n") - F.col("piece") * top).alias("n_tokens"))
    kind = docs.schema[id_col].dataType.simpleString()

    def work(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("n_tokens", "descending"), ("id", "ascending"), ("piece", "ascending")])
        lengths = shard["n_tokens"].to_numpy()
        full = int((lengths > 0).sum())
        bins, offsets, size = best_fit(lengths[:full], capacities, price)
        none = pa.nulls(len(lengths) - full, pa.int64())
        for name, values in (("bin_id", (shard["shard"].to_numpy()[:full] << 32) + bins), ("bin_offset", offsets), ("capacity", size[bins])):
            shard = shard.append_column(name, pa.chunked_array([pa.array(values, pa.int64()), none]))
        return shard.drop_columns(["shard"])

    packed = pieces.groupBy("shard").applyInArrow(work, f"id {kind}, piece bigint, piece_start bigint, n_tokens bigint, bin_id bigint, bin_offset bigint, capacity bigint")
    return packed.withColumnRenamed("id", id_col)
