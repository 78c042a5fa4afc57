"""Numeric text files as feature tables: one line is one point, rows numbered in line order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.operators.layout import convert, shape, transpose

# A point is one row, so its features have to fit into one.
MAX_DIM = 1_000_000
# Field separators by file kind (regular expressions).
SEPARATORS = {"csv": ",", "tsv": "\t", "txt": "\\s+", "arff": ","}


def _kind(path: str) -> str:
    ext = path.rsplit(".", 1)[-1].lower() if "." in path else ""
    if ext not in SEPARATORS:
        raise ValueError(f"cannot tell the format of {path!r}; pass kind=")
    return ext


def read_lines(spark: SparkSession, path: str | Sequence[str], skip: str = r"^\s*$") -> DataFrame:
    """(row_id, value): lines numbered from 0 in file order, without those that match ``skip``.

    A split of a file is read front to back by one task, so its lines are numbered where
    they lie, and move up by the lines of the splits before it: one number per split.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    kept = lines.filter(~F.col("value").rlike(skip)).withColumn("_line", F.monotonically_increasing_id())
    splits = kept.groupBy("_file", "_block").agg(F.min("_line").alias("_first"), F.count("*").alias("n")).toPandas().sort_values(["_file", "_block"])
    splits["_offset"] = splits["n"].cumsum() - splits["n"] - splits["_first"]
    moves = spark.createDataFrame(splits[["_file", "_block", "_offset"]], "_file string, _block bigint, _offset bigint")
    return kept.join(moves, ["_file", "_block"]).select((F.col("_line") + F.col("_offset")).alias("row_id"), "value")


def load(
    spark: SparkSession,
    path: str,
    *,
    kind: str | None = None,
    transposed: bool = True,
    layout: str = "vector",
    dim: int | None = None,
) -> DataFrame:
    """Headerless numeric text (csv, tsv, whitespace txt, or the data section of arff).

    ``transposed`` (the default) makes each line a point; otherwise each file column is
    one.  ``layout`` is vector, long or wide.  A malformed number is an error.
    """
    form = kind or _kind(path)
    lines = read_lines(spark, path, r"^\s*([%@].*)?$") if form == "arff" else read_lines(spark, path)
    fields = F.split(F.trim("value"), SEPARATORS[form])
    points = lines.select("row_id", F.transform(fields, lambda x: F.trim(x).cast("double")).alias("features"))
    if transposed:
        if layout == "wide" and dim is None:
            dim = shape(points)[1]
        return convert(points, "vector", layout, dim=dim)
    cells = transpose(convert(points, "vector", "long"))
    if layout == "long":
        return cells
    dim = points.count()
    if dim > MAX_DIM:
        raise ValueError(f"columns of {dim} lines make points of that many features; load them with layout='long'")
    return convert(cells, "long", layout, dim=dim)


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    """(row_id, label): one integer per line, aligned with a data file by line."""
    return read_lines(spark, path).select("row_id", F.trim("value").cast("double").cast("int").alias("label"))
