"""Row lookup by flat index or grid coordinate: clamp, then an equi-join on the row id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.operators.joins import join_unique
from vectable.operators.layout import clamp_index, flat_index


def lookup(query: DataFrame, data: DataFrame, *, index_col: str = "idx", id_col: str = "row_id", n: int | None = None) -> DataFrame:
    """For each query row the data row at its clamped index; repeats and extra query columns are kept."""
    size = data.count() if n is None else n
    if size == 0:
        raise ValueError("lookup needs a data set")
    return join_unique(query.withColumn(id_col, clamp_index(F.col(index_col), size)), data, id_col)


def lookup_grid(
    query: DataFrame,
    data: DataFrame,
    *,
    width: int,
    x_col: str = "x",
    y_col: str = "y",
    id_col: str = "row_id",
    n: int | None = None,
) -> DataFrame:
    """Lookup by (x, y) in a data set whose row id is y * width + x."""
    size = data.count() if n is None else n
    if size == 0:
        raise ValueError("lookup needs a data set")
    height = -(-size // width)
    idx = clamp_index(flat_index(F.col(x_col), F.col(y_col), width, height), size)
    return join_unique(query.withColumn(id_col, idx), data, id_col)


def attach(points: DataFrame, other: DataFrame, id_col: str = "row_id", how: str = "inner") -> DataFrame:
    """Labels or targets aligned with points, as a join on the row id instead of on position."""
    return join_unique(points, other, id_col, how)
