"""Concatenation of feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_schema(a: DataFrame, b: DataFrame) -> bool:
    return [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]


def append_rows(frames: Sequence[DataFrame], id_col: str = "row_id") -> DataFrame:
    """Stack tables whose ids are 0..n-1 each; ids of later tables move up by the rows before them.

    A change of schema starts over: tables before the last change are dropped.
    """
    kept: list[DataFrame] = []
    for frame in frames:
        if kept and not same_schema(kept[-1], frame):
            kept = []
        kept.append(frame)
    if not kept:
        raise ValueError("nothing to append")
    offset, shifted = 0, []
    for i, frame in enumerate(kept):
        shifted.append(frame.withColumn(id_col, F.col(id_col).cast("bigint") + F.lit(offset).cast("bigint")))
        if i + 1 < len(kept):
            top = frame.agg(F.max(id_col)).first()[0]
            offset += 0 if top is None else int(top) + 1
    return reduce(DataFrame.unionByName, shifted)


def append_points_long(frames: Sequence[DataFrame], id_col: str = "row_id") -> DataFrame:
    """The same on the long layout, where points are columns of the matrix."""
    return append_rows(frames, id_col)
