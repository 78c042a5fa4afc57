"""Layouts of a feature table (wide, vector, long), casts, coordinates and shape checks.

wide    ``id, f0 .. f{d-1}``          one column per feature
vector  ``id, features ARRAY<DOUBLE>`` the canonical layout
long    ``id, feature_idx, value``     one row per cell, also the transposed view
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.functions.exprs import clamp

LAYOUTS = ("wide", "vector", "long")


def wide_to_vector(df: DataFrame, feature_cols: Sequence[str], id_col: str = "row_id") -> DataFrame:
    return df.select(id_col, F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("features"))


def vector_to_wide(df: DataFrame, dim: int, id_col: str = "row_id", prefix: str = "f") -> DataFrame:
    return df.select(id_col, *[F.get("features", F.lit(i)).alias(f"{prefix}{i}") for i in range(dim)])


def vector_to_long(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    return df.select(id_col, F.posexplode("features").alias("feature_idx", "value"))


def long_to_vector(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Cells back to vectors; a group is one point, so its size is the dimensionality."""
    cells = F.array_sort(F.collect_list(F.struct("feature_idx", "value")))
    return df.groupBy(id_col).agg(cells.alias("cells")).select(
        id_col, F.transform("cells", lambda c: c["value"].cast("double")).alias("features")
    )


def wide_to_long(df: DataFrame, feature_cols: Sequence[str], id_col: str = "row_id") -> DataFrame:
    return vector_to_long(wide_to_vector(df, feature_cols, id_col), id_col)


def long_to_wide(df: DataFrame, dim: int, id_col: str = "row_id", prefix: str = "f") -> DataFrame:
    aggs = [F.first(F.when(F.col("feature_idx") == i, F.col("value")), ignorenulls=True).alias(f"{prefix}{i}") for i in range(dim)]
    return df.groupBy(id_col).agg(*aggs)


def convert(
    df: DataFrame,
    source: str,
    target: str,
    *,
    dim: int | None = None,
    feature_cols: Sequence[str] | None = None,
    id_col: str = "row_id",
) -> DataFrame:
    """Any layout to any other; the same layout passes through unchanged."""
    if source not in LAYOUTS or target not in LAYOUTS:
        raise ValueError(f"layouts are {LAYOUTS}")
    if source == target:
        return df
    if source == "wide":
        if feature_cols is None:
            raise ValueError("feature_cols names the features of a wide table")
        return wide_to_vector(df, feature_cols, id_col) if target == "vector" else wide_to_long(df, feature_cols, id_col)
    if target == "wide":
        if dim is None:
            raise ValueError("dim fixes the number of columns of a wide table")
        return vector_to_wide(df, dim, id_col) if source == "vector" else long_to_wide(df, dim, id_col)
    return vector_to_long(df, id_col) if source == "vector" else long_to_vector(df, id_col)


def transpose(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Swap points and features of a *long* table; no data moves until it is regrouped."""
    return df.select(F.col("feature_idx").cast("bigint").alias(id_col), F.col(id_col).cast("bigint").alias("feature_idx"), "value")


def cast_double(column: str) -> Column:
    return F.transform(F.col(column), lambda x: x.cast("double"))


def cast_long(column: str) -> Column:
    return F.transform(F.col(column), lambda x: x.cast("bigint"))


def coords(index: Column, width: int) -> tuple[Column, Column]:
    """Flat index to (x, y) on a grid of the given width."""
    i = index.cast("bigint")
    return i % width, F.floor(i / F.lit(width)).cast("bigint")


def flat_index(x: Column, y: Column, width: int, height: int) -> Column:
    """(x, y) clamped to the grid, then to a flat index."""
    return clamp(y.cast("bigint"), 0, height - 1) * F.lit(width) + clamp(x.cast("bigint"), 0, width - 1)


def clamp_index(index: Column, n: int) -> Column:
    return clamp(index.cast("bigint"), 0, n - 1)


def shape(df: DataFrame, features_col: str = "features") -> tuple[int, int]:
    """(rows, dimensionality); raises when vectors are NULL or differ in length."""
    row = df.select(F.size(features_col).alias("s"), F.col(features_col).isNull().alias("is_null")).agg(
        F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.max("is_null").alias("nulls")
    ).first()
    if row["n"] == 0:
        return 0, 0
    if row["nulls"]:
        raise ValueError("NULL feature vector")
    if row["lo"] != row["hi"]:
        raise ValueError(f"feature vectors have lengths {row['lo']} to {row['hi']}")
    return row["n"], row["hi"]


def require_dim(df: DataFrame, dim: int, features_col: str = "features") -> DataFrame:
    """Check at run time that each vector has the fitted length."""
    bad = F.raise_error(F.lit(f"feature vector does not have the fitted length {dim}"))
    ok = F.col(features_col).isNotNull() & (F.size(features_col) == dim)
    return df.withColumn(features_col, F.when(ok, F.col(features_col)).otherwise(bad))


def drop_invalid(df: DataFrame, features_col: str = "features") -> DataFrame:
    """The ``skip`` policy for NULL and NaN features (they are an error otherwise)."""
    return df.filter(F.col(features_col).isNotNull() & ~F.exists(features_col, lambda x: x.isNull() | F.isnan(x)))


def label_summary(df: DataFrame, label_col: str = "label") -> DataFrame:
    """One row: number of classes, and whether labels are exactly 0 .. max."""
    lab = F.col(label_col)
    return df.groupBy(lab.alias("label")).agg(F.count("*").alias("n")).agg(
        (F.max("label") + 1).cast("bigint").alias("n_classes"),
        F.count("label").alias("n_distinct"),
        ((F.min("label") == 0) & (F.count("label") == F.max("label") + 1)).alias("contiguous"),
    )


def require_contiguous_labels(df: DataFrame, label_col: str = "label") -> int:
    row = label_summary(df, label_col).first()
    if row["n_classes"] is None:
        raise ValueError("no labels")
    if not row["contiguous"]:
        raise ValueError("labels must be the integers 0 .. max without gaps")
    return int(row["n_classes"])


def mismatch_counts(data: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """One row: points without a label and labels without a point.

    Both sides are reduced to one flag per id before they meet, so no id is heavy.
    """
    flags = data.select(id_col, F.lit(1).alias("d"), F.lit(0).alias("l")).unionByName(
        labels.select(id_col, F.lit(0).alias("d"), F.lit(1).alias("l"))
    )
    per_id = flags.groupBy(id_col).agg(F.sum("d").alias("d"), F.sum("l").alias("l"))
    return per_id.agg(
        F.sum(F.when(F.col("l") == 0, F.col("d")).otherwise(0)).alias("points_without_label"),
        F.sum(F.when(F.col("d") == 0, F.col("l")).otherwise(0)).alias("labels_without_point"),
    )
