"""Whole texts as numpy arrays, a bounded slice of an Arrow batch at a time, and keyed groups of sorted rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.session import cut_lineage

SLICE_BYTES = 1 << 20
OUT_ROWS = 4096
# What sets the two runs of a longer one apart, and the odd multipliers of the 64-bit mixer.
RUN_SALT = 0x9E3779B97F4A7C15
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def space_table() -> np.ndarray:
    """Which bytes separate words: 0x20 and 0x09 to 0x0D."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


SPACE = space_table()
#: Masks of the first 0 to 8 bytes of a number.
LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


@dataclass
class Slice:
    """Rows [first, last) of a batch: their UTF-8 bytes, and where each text begins and the last one ends."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in runs of at most `limit` bytes; a longer text is a run of its own.  NULL reads as empty."""
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every run of `inside` bytes, and the text it is in; runs end with their text."""
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(MIX[0])
    h ^= h >> np.uint64(33)
    h = h * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever it stands; seeds give independent ones.

    Up to 16 bytes are read as two numbers and mixed with the length, so that
    words of up to 8 bytes and one length never share a hash; longer words go
    through XXH3.
    """
    n = ends - starts
    if not len(n):
        return np.empty(0, np.uint64)
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(16, np.uint8))), 8)
    low, high = (np.ascontiguousarray(eights[np.minimum(starts + k, len(data))]).view("<u8")[:, 0].astype(np.uint64) & LOW_BYTES[np.clip(n - k, 0, 8)] for k in (0, 8))
    salt = mixed(np.array([seed + 1], np.uint64))
    h = mixed(low ^ mixed(high ^ mixed(n.astype(np.uint64) + salt)))
    for k in np.flatnonzero(n > 16):
        h[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes(), seed)
    return h


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n consecutive words, by its first word; runs may cross texts.

    Runs double: the hash of a run is mixed from those of the two shorter runs that cover it.
    """
    if len(words) < n:
        return np.empty(0, np.uint64)
    return sliding(words, n, lambda first, second: mixed(first ^ mixed(second + np.uint64(RUN_SALT))))


def sliding(values: np.ndarray, width: int, best: Callable) -> np.ndarray:
    """best (np.minimum, np.maximum) over each `width` consecutive values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = best(out[:-step], out[step:])
        done += step
    return out


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def counts_to_offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts))).astype(np.int32)


def in_blocks(members: DataFrame, keys: list[str], row_hash: Column, block_rows: int) -> DataFrame:
    """Cut groups so that no task has to hold one: adds the columns lo, hi, part.

    A group of more than `block_rows` rows is dealt into parts by hash; its
    rows go once to every pair (lo, hi) that their part is in.  Comparing part
    lo with part hi of every pair visits each pair of rows of the group once.
    """
    large = cut_lineage(members.groupBy(*keys).count().where(F.col("count") > block_rows))
    if large.isEmpty():
        return members.withColumns({"lo": F.lit(0), "hi": F.lit(0), "part": F.lit(0)})
    parts = F.ceil(F.coalesce("count", F.lit(1)) / block_rows).cast("int")
    dealt = members.join(large, keys, "left").withColumn("_parts", parts).withColumn("part", F.pmod(row_hash, F.col("_parts")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return dealt.withColumns({"lo": F.least("part", "_other"), "hi": F.greatest("part", "_other")}).drop("_parts", "_other", "count")


def keyed_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 1) -> Iterator[pa.Table]:
    """The groups of at least `least` rows of a stream of batches in which rows of equal keys stand together."""

    def whole() -> Iterator[pa.Table]:
        if sum(t.num_rows for t in open_group) >= least:
            yield pa.concat_tables(open_group).combine_chunks()

    open_group: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            # Groups inside a batch that are too small are passed over without being cut out.
            if 0 < lo and hi < batch.num_rows and hi - lo < least:
                yield from whole()
                open_group = []
                continue
            key = tuple(c[lo] for c in columns)
            if open_group and key != last:
                yield from whole()
                open_group = []
            open_group.append(table.slice(lo, hi - lo))
            last = key
    yield from whole()


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, least_bytes: int) -> Iterator[pa.Table]:
    """A stream of batches in which rows of equal keys stand together, as tables of about `least_bytes` that part no key."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        if sum(t.nbytes for t in held) < least_bytes:
            continue
        table = pa.concat_tables(held)
        keys = table[key].to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        last = int(other[-1]) + 1 if len(other) else 0
        if last:
            yield table.slice(0, last).combine_chunks()
        held = [table.slice(last)]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def by_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str, least: int = 2) -> DataFrame:
    """`work` on every group of at least `least` rows; many small groups share a task and a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[pa.RecordBatch] = []
        for group in keyed_groups(batches, keys, least):
            out = work(group)
            if out is not None and out.num_rows:
                ready.append(out)
            if sum(r.num_rows for r in ready) >= OUT_ROWS or len(ready) >= OUT_ROWS:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                ready = []
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
