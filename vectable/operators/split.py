"""Train/test split as a row predicate: both sides are filters of the input, nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.operators.lookup import attach
from vectable.operators.layout import mismatch_counts
from vectable.operators.order import lowest_hashes, nth_smallest


def test_rows(df: DataFrame, ratio: float = 0.2, *, shuffle: bool = True, id_col: str = "row_id", seed: int = 0) -> Column:
    """Predicate of the floor(n * ratio) test rows.

    Shuffled: the rows with the lowest id hash.  Otherwise: the tail in id order.
    Rows without an id are training rows and do not count for the ratio.
    """
    ratio = min(1.0, max(0.0, ratio))
    known = F.col(id_col).isNotNull()
    df = df.filter(known)
    n = df.count()
    n_test = int(n * ratio)
    if n_test == 0:
        return F.lit(False)
    if n_test == n:
        return known
    if shuffle:
        return known & F.coalesce(lowest_hashes(df, n_test, id_col, seed, n), F.lit(False))
    first, _ = nth_smallest(df, F.col(id_col), n - n_test)
    return known & F.coalesce(F.col(id_col) >= first, F.lit(False))


def split(df: DataFrame, ratio: float = 0.2, *, shuffle: bool = True, id_col: str = "row_id", seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    is_test = test_rows(df, ratio, shuffle=shuffle, id_col=id_col, seed=seed)
    return df.filter(~is_test), df.filter(is_test)


def split_with_labels(
    data: DataFrame,
    labels: DataFrame,
    ratio: float = 0.2,
    *,
    shuffle: bool = True,
    id_col: str = "row_id",
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of points with their labels; every point needs exactly one label."""
    gaps = mismatch_counts(data, labels, id_col).first()
    if gaps["points_without_label"] or gaps["labels_without_point"]:
        raise ValueError(f"data and labels differ: {gaps.asDict()}")
    return split(attach(data, labels, id_col), ratio, shuffle=shuffle, id_col=id_col, seed=seed)
