"""Prefix products along sequences of any length.

A sequence is cut into chunks; each chunk acts on a vector of S state weights as an
S x S matrix.  The vector that enters chunk c is the start vector times the product
of all earlier chunks.  Products are taken in groups of bounded size, and groups of
groups above them, so the longest sequence needs log(chunks) rounds and no task sees
more than FAN_IN matrices of a sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.functions.blocks import from_matrix, to_matrix

FAN_IN = 256


def log_times(v: np.ndarray, m: np.ndarray, best: bool) -> np.ndarray:
    """(..., S) times (..., S, S) on log weights: sums of paths, or the best path only."""
    terms = v[..., :, None] + m
    top = terms.max(axis=-2)
    if best:
        return top
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(terms - safe[..., None, :]).sum(axis=-2)) + safe


def _square(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return to_matrix(column).reshape(-1, size, size)


def entering(mats: DataFrame, start: np.ndarray, *, best: bool = False, fan_in: int = FAN_IN) -> DataFrame:
    """(seq, c, entry) for chunks ``mats`` (seq, c, m): the vector that enters each chunk."""
    size = len(start)
    kind = mats.schema["seq"].dataType.simpleString()
    last = mats.agg(F.max("c")).first()[0]
    if last is None:
        return mats.select("seq", "c", F.lit(None).cast("array<double>").alias("entry"))
    grouped = mats.withColumn("g", F.expr(f"c div {fan_in}"))
    if last < fan_in:
        begin = F.lit(0).cast("bigint")
        above = mats.filter(F.col("c") == 0).select("seq", begin.alias("g"), F.array(*[_weight(v) for v in start]).alias("into"))
    else:

        def product(rows: pa.Table) -> pa.Table:
            order = np.argsort(rows["c"].to_numpy())
            total = None
            for m in _square(rows["m"], size)[order]:
                total = m if total is None else log_times(total, m, best)
            return pa.table({"seq": rows["seq"][:1], "c": rows["g"][:1], "m": from_matrix(total.reshape(1, -1))})

        tops = grouped.groupBy("seq", "g").applyInArrow(product, f"seq {kind}, c bigint, m array<double>")
        above = entering(tops, start, best=best, fan_in=fan_in).select("seq", F.col("c").alias("g"), F.col("entry").alias("into"))

    def spread(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["c"].to_numpy())
        v, out = to_matrix(rows["into"])[0], np.empty((rows.num_rows, size))
        for at, m in zip(order, _square(rows["m"], size)[order]):
            out[at] = v
            v = log_times(v, m, best)
        return pa.table({"seq": rows["seq"], "c": rows["c"], "entry": from_matrix(out)})

    joined = grouped.join(above, ["seq", "g"])
    return joined.groupBy("seq", "g").applyInArrow(spread, f"seq {kind}, c bigint, entry array<double>")


def _weight(value: float) -> Column:
    return F.lit(float(value))
