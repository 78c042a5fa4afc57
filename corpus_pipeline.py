"""Documents cleaned and packed for training, a stage at a time.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the docs of the next one.  All stages but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm import decontamination, language, packing, secrets, simhash
from vectable.plans.common import table
from vectable.session import scratch_path, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and texts whose language cannot be told from a second one.

    If no row of docs has a language to learn from, every text with a letter stays.
    """
    ship_package(spark)
    model = language.fit(docs, "text", "lang", F.lit(True))
    if not model.languages:
        return docs.where(F.col("text").rlike(language.LETTER))
    told = language.identify(docs, model, prediction="__lang", score="__score", ambiguous="__ambiguous")
    return told.where((F.col("__lang") != language.UNKNOWN) & ~F.col("__ambiguous")).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one with the smallest id.

    Near are texts whose fingerprints of 3-word shingles differ in at most 3
    bits, as op2 has them.  Rows that share this id are one document; the one
    with the least text stays.  Rows without an id cannot be told apart by it
    and stay.
    """
    ship_package(spark)
    return simhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    ship_package(spark)
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mask in the place of every secret; n_chars follows where a text has changed."""
    ship_package(spark)
    spans = F.col("__spans")
    found = secrets.find(docs, spans="__spans").withColumn("__clean", secrets.redact(F.col("text"), spans))
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.size(spans) > 0, F.length("__clean").cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumns({"text": F.col("__clean"), "n_chars": length}).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin, place and length of every piece of every document."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL states neither the learned language model nor the packing; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
