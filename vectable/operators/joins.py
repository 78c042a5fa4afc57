"""Equi-joins against a table with unique keys, safe when one key holds much of the left side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 200


def join_unique(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", min_rows: int = 1_000_000, counts: DataFrame | None = None
) -> DataFrame:
    """Join ``left`` to a right side that has at most one row per ``key``.

    A key is heavy when it has more than 1/MAX_HOT_KEYS of the left rows, so there are
    at most MAX_HOT_KEYS of them.  Heavy left rows meet the few right rows they need by
    broadcast; the rest is an ordinary join.  Small left sides skip the search.
    ``counts`` (key, count) can be given when it is known more cheaply.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    per_key = left.groupBy(key).count() if counts is None else counts
    total = left.count() if counts is None else (counts.agg(F.sum("count")).first()[0] or 0)
    if total < min_rows:
        return left.join(right, key, how)
    hot = [r[0] for r in per_key.filter(F.col("count") > total // MAX_HOT_KEYS).select(key).collect() if r[0] is not None]
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    hot_part = left.filter(is_hot).join(F.broadcast(right.filter(F.col(key).isin(hot))), key, how)
    return left.filter(~is_hot).join(right.filter(~is_hot), key, how).unionByName(hot_part)
