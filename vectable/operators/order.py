"""Order statistics and running totals without a single-task sort."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.functions.hashing import WORD, row_hash
from vectable.session import cut_lineage

FANOUT = 65536


def nth_smallest(df: DataFrame, key: Column, rank: int, bounds: tuple[int, int] | None = None) -> tuple[int, int]:
    """Exact value at a 0-based rank of a bigint expression, and how many rows lie below it.

    Narrows [min, max] by counting FANOUT equal ranges per pass: a 32-bit key
    takes two aggregations, a 64-bit key four, and nothing is sorted.  Known
    ``bounds`` save the pass that finds them.
    """
    keyed = df.select(key.cast("bigint").alias("k"))
    if bounds is None:
        row = keyed.agg(F.min("k").alias("lo"), F.max("k").alias("hi")).first()
        if row["lo"] is None:
            raise ValueError("no rows to rank")
        bounds = row["lo"], row["hi"]
    (lo, hi), below = bounds, 0
    while lo < hi:
        width = (hi - lo) // FANOUT + 1
        cell = F.expr(f"(k - ({lo}L)) div {width}L")
        found = keyed.filter(F.col("k").between(lo, hi)).groupBy(cell.alias("b")).count().toArrow()
        cells, counts = found["b"].to_numpy(), found["count"].to_numpy()
        order = np.argsort(cells)
        reached = below + np.cumsum(counts[order])
        at = int(np.searchsorted(reached, rank, side="right"))
        if rank < 0 or at == len(order):
            raise ValueError(f"rank {rank} is outside the table")
        below = int(reached[at] - counts[order[at]])
        start = lo + int(cells[order[at]]) * width
        lo, hi = start, min(hi, start + width - 1)
    return lo, below


def lowest_hashes(df: DataFrame, n: int, id_col: str, seed: int, total: int | None = None) -> Column:
    """Predicate that is true for exactly the n rows with the lowest (hash, id)."""
    if n <= 0:
        return F.lit(False)
    if n >= (df.count() if total is None else total):
        return F.lit(True)
    h = row_hash(F.col(id_col), seed)
    cut, below = nth_smallest(df, h, n - 1, (0, WORD - 1))
    last_id, _ = nth_smallest(df.filter(h == cut), F.col(id_col), n - below - 1)
    return F.struct(h, F.col(id_col).cast("bigint")) <= F.struct(F.lit(cut).cast("bigint"), F.lit(last_id).cast("bigint"))


def sample_rows(df: DataFrame, k: int, id_col: str = "row_id", seed: int = 0) -> DataFrame:
    """k rows drawn by hash order; a top-k over per-task top-k lists, no full sort."""
    return df.orderBy(row_hash(F.col(id_col), seed), F.col(id_col)).limit(k)


def _starts(columns: list[pa.Array], previous: list | None) -> np.ndarray:
    """True where the group differs from the row before."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    for i, col in enumerate(columns):
        if n > 1:
            same = pc.equal(col[1:], col[:-1])
            both_null = pc.and_(pc.is_null(col[1:]), pc.is_null(col[:-1]))
            same = pc.or_(pc.fill_null(same, False), both_null)
            new[1:] |= ~same.to_numpy(zero_copy_only=False)
        if previous is None or col[0].as_py() != previous[i]:
            new[0] = True
    return new


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, least_rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, begins): a stream of batches sorted by its first columns, in tables of at least so many rows that part no group.

    begins are the first rows of the groups of the table, and its end.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def ready(table: pa.Table, last: bool) -> tuple[pa.Table, np.ndarray]:
        at = np.flatnonzero(_starts([table.column(i).chunk(0) for i in range(keys)], None))
        return table, np.append(at, table.num_rows) if last else at

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows < least_rows:
            continue
        table, at = ready(pa.Table.from_batches(held).combine_chunks(), False)
        if at[-1]:
            yield table.slice(0, at[-1]), at
        held = table.slice(at[-1]).combine_chunks().to_batches()
        rows = table.num_rows - int(at[-1])
    if rows:
        yield ready(pa.Table.from_batches(held).combine_chunks(), True)


def running_totals(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    totals: dict[str, str | None],
) -> DataFrame:
    """Inclusive running totals per group, in order; a value of ``None`` counts rows.

    The table is range-partitioned on (group, order), so a group of any size is
    spread over tasks.  Each task totals its own run of rows; what a run inherits
    from earlier partitions is one value per partition, added by a broadcast join
    of at most as many rows as there are partitions.  ``order_cols`` must make
    rows distinct, otherwise equal rows stay in one partition.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    placed = df.repartitionByRange(*group_cols, *order_cols).sortWithinPartitions(*group_cols, *order_cols)
    placed = placed.withColumn("__pid", F.spark_partition_id())
    names = list(totals)
    fields = placed.schema.fields
    schema = T.StructType(
        fields
        + [T.StructField(n, T.LongType() if totals[n] is None else T.DoubleType()) for n in names]
        + [T.StructField("__run", T.LongType()), T.StructField("__at", T.LongType())]
    )
    width = len(fields)
    group_at = [placed.columns.index(c) for c in group_cols]
    value_at = {n: None if totals[n] is None else placed.columns.index(totals[n]) for n in names}

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous, run, at = None, -1, 0
        carry = {n: 0 if value_at[n] is None else 0.0 for n in names}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys = [batch.column(i) for i in group_at]
            new = _starts(keys, previous)
            runs = run + np.cumsum(new)
            first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            out = []
            for name in names:
                col = value_at[name]
                if col is None:
                    total = np.arange(1, n + 1) - np.where(first >= 0, first, -carry[name])
                else:
                    # A sum for each run, so that neither NaN nor a large value of one group reaches another.
                    v = batch.column(col).to_numpy(zero_copy_only=False).astype(float)
                    total = np.empty(n)
                    edges = [0, *np.flatnonzero(new[1:]) + 1, n]
                    for a, b in zip(edges, edges[1:]):
                        total[a:b] = np.cumsum(v[a:b])
                    total[: edges[1]] += 0.0 if new[0] else carry[name]
                out.append(total)
                carry[name] = total[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(width)]
                + [pa.array(o) for o in out]
                + [pa.array(runs), pa.array(np.arange(at, at + n))],
                names=schema.names,
            )
            previous, run, at = [k[n - 1].as_py() for k in keys], int(runs[-1]), at + n

    # Range boundaries are sampled, so the placement is fixed here, together with the local totals.
    ran = cut_lineage(placed.mapInArrow(local, schema))
    key = F.struct(*group_cols)
    ends = (
        ran.groupBy("__pid")
        .agg(
            F.min_by(key, "__at").alias("first"),
            F.max_by(F.struct(key.alias("key"), "__run", *names), "__at").alias("last"),
        )
        .orderBy("__pid")
        .collect()
    )
    inherited, before = [], None
    for row in ends:
        carried = {n: 0 for n in names}
        if before is not None and row["first"] == before["key"]:
            carried = before["totals"]
            inherited.append((row["__pid"], *[carried[n] for n in names]))
        last = row["last"]
        extra = carried if last["__run"] == 0 else {n: 0 for n in names}
        before = {"key": last["key"], "totals": {n: last[n] + extra[n] for n in names}}
    if inherited:
        carry_schema = "__pid int, " + ", ".join(
            f"`__c_{n}` {'bigint' if totals[n] is None else 'double'}" for n in names
        )
        carries = df.sparkSession.createDataFrame(inherited, carry_schema)
        ran = ran.join(F.broadcast(carries), "__pid", "left")
        for n in names:
            add = F.when(F.col("__run") == 0, F.coalesce(F.col(f"__c_{n}"), F.lit(0))).otherwise(F.lit(0))
            ran = ran.withColumn(n, F.col(n) + add)
    return ran.select(*df.columns, *names)


def sequence_position(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], name: str = "pos") -> DataFrame:
    """0-based position of each row within its group."""
    return running_totals(df, group_cols, order_cols, {name: None}).withColumn(name, F.col(name) - 1)


def row_index(df: DataFrame, order_cols: Sequence[str], name: str = "row_id") -> DataFrame:
    """Dense 0-based row index of the whole table in the given order."""
    tagged = df.withColumn("_all", F.lit(0))
    return sequence_position(tagged, ["_all"], order_cols, name).drop("_all")
