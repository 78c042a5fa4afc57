"""Lines that several documents hold, dropped everywhere but in the first of them; DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.operators.joins import MAX_HOT_KEYS
from vectable.session import cut_lineage

LEAST_CHARS = 10
LEAST_DOCUMENTS = 2
#: What is stripped at either end of a line.
BLANKS = " \t\n\x0b\f\r"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """The normalised lines of a text, in order."""
    bare = F.transform(lines_of(text), lambda line: F.btrim(line, F.lit(BLANKS)))
    return F.transform(bare, ascii_lower)


def line_hash(key: Column) -> Column:
    """128 bits of SHA-256, so that equal hashes stand for equal keys at any number of lines."""
    return F.unhex(F.left(F.sha2(key, 256), F.lit(32)))


def repeated_keys(lines: DataFrame, least_documents: int) -> DataFrame:
    """(h, n_docs, first) of the hashes in at least so many documents; rows without an id are one document, after all others."""
    counted = lines.groupBy("h").agg(
        (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("n_docs"),
        F.min("id").alias("first"),
    )
    return counted.where(F.col("n_docs") >= least_documents)


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", *, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(id, text, n_lines, n_dropped) for every row of df: its text without the lines that other documents hold as well.

    A text is split at newlines; a NULL or empty one is one empty line.  The
    key of a line is the line without blanks at its ends, A-Z in lower case.
    Lines whose key has at least `least_chars` code points and stands in at
    least `least_documents` documents stay only in the document with the
    smallest id; there all of them stay.  Repeated rows of an id are one
    document.  Rows without an id are together one document that comes after
    all others.  Other lines stay as they are, joined by newlines; a text that
    loses all lines is empty.

    Hashes of keys are counted after one exchange of different (hash, id) and
    one of partial counts.  Hashes that stand in more than 1/200 of these
    (there can be at most 200) are sent to all tasks, others are joined, so no
    task meets all rows of a frequent line.  Only the positions of dropped
    lines come back to a document; its text crosses the network once.
    """
    if least_chars < 0 or least_documents < 2:
        raise ValueError("least_chars is at least 0, least_documents at least 2")
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("copy"), F.col(text).alias("text"))
    exploded = docs.select("id", "copy", F.posexplode(line_keys(F.col("text"))).alias("pos", "key"))
    lines = exploded.where(F.char_length("key") >= least_chars).select("id", "copy", "pos", line_hash(F.col("key")).alias("h"))

    repeated = cut_lineage(repeated_keys(lines.select("id", "h"), least_documents))
    pairs = repeated.agg(F.sum("n_docs")).first()[0] or 0
    frequent = F.broadcast(repeated.where(F.col("n_docs") > pairs // MAX_HOT_KEYS).select("h", F.col("first").alias("frequent_first"), F.lit(True).alias("frequent")))
    # The key of a line that has met its hash already is longer than a hash: it meets nothing and is dealt by its row.
    spread = F.when(F.col("frequent"), F.concat("h", F.encode(F.concat_ws(":", "copy", "pos"), "utf-8"))).otherwise(F.col("h"))
    marked = lines.join(frequent, "h", "left").withColumn("h", spread)
    met = marked.join(repeated.select("h", F.lit(True).alias("found"), "first"), "h", "left").where(F.col("frequent") | F.col("found"))
    keeper = F.when(F.col("frequent"), F.col("frequent_first")).otherwise(F.col("first"))
    dropped = met.where(~F.col("id").eqNullSafe(keeper)).groupBy("id", "copy").agg(F.collect_set("pos").alias("dropped"))

    gone = dropped.withColumnsRenamed({"id": "gone_id", "copy": "gone_copy"}).hint("shuffle_hash")
    joined = docs.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("copy") == F.col("gone_copy")), "left")
    lines_in = lines_of(F.col("text"))
    last = F.size(lines_in) - 1
    kept = F.array_except(F.sequence(F.lit(0), last), F.col("dropped"))
    # Bound to a variable, the lines are cut once and not again for each of them.
    rest = F.get(F.transform(F.array(lines_in), lambda ls: F.array_join(F.transform(kept, lambda i: F.get(ls, i)), "\n")), F.lit(0))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(rest).alias(text),
        F.size(lines_in).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
