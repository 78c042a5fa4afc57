"""Scalers on line item columns and embeddings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.operators import moments as mo, scaling
from vectable.plans.common import LINEITEM_FEATURES, LINEITEM_KEY, Catalog, embeddings, lineitem, rnd, rnd_sql

catalog = Catalog()
KEY = ", ".join(LINEITEM_KEY)


def _sql(formula: str) -> str:
    """Scale every feature; {x} is the column, {a} its aggregates."""
    aggs, outs = [], []
    for c in LINEITEM_FEATURES:
        aggs.append(
            f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max, max(abs({c})) AS {c}_abs"
        )
        outs.append(rnd_sql(formula.replace("{x}", c)) + f" AS {c}")
    return f"WITH a AS (SELECT {', '.join(aggs)} FROM lineitem) SELECT {KEY}, {', '.join(outs)} FROM lineitem, a"


def _wide(df: DataFrame) -> DataFrame:
    return df.select(*LINEITEM_KEY, *[rnd(F.get("features", F.lit(i))).alias(c) for i, c in enumerate(LINEITEM_FEATURES)])


def _scaled(kind: str, **options: float) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _wide(scaling.fit_scale(lineitem(spark, sf), kind, **options)[1])

    return run


for _name, _kind, _options, _formula in (
    ("scale_standard", "standard", {}, "({x} - {x}_mean) / {x}_std"),
    ("scale_minmax", "min_max", {"low": -1.0, "high": 1.0}, "-1.0 + ({x} - {x}_min) * 2.0 / ({x}_max - {x}_min)"),
    ("scale_meannorm", "normalization", {}, "({x} - {x}_mean) / ({x}_max - {x}_min)"),
    ("scale_maxabs", "abs", {}, "{x} / {x}_abs"),
):
    catalog.queries[_name] = _scaled(_kind, **_options)
    catalog.oracle[_name] = _sql(_formula)


@catalog.query(f"SELECT {KEY}, " + ", ".join(rnd_sql(c) + f" AS {c}" for c in LINEITEM_FEATURES) + " FROM lineitem")
def scale_inverse_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    scaler, scaled = scaling.fit_scale(lineitem(spark, sf), "min_max", low=2.0, high=5.0)
    return _wide(scaling.unscale(scaled, scaler))


@catalog.query(
    " UNION ALL ".join(
        f"SELECT {i}::INT AS feature_idx, {rnd_sql(f'avg({c})', 8)} AS mean, {rnd_sql(f'stddev_pop({c})', 8)} AS std, "
        f"min({c}) AS min, max({c}) AS max, max(abs({c})) AS max_abs FROM lineitem"
        for i, c in enumerate(LINEITEM_FEATURES)
    )
)
def feature_moments(spark: SparkSession, sf: str) -> DataFrame:
    m = mo.moments_table(lineitem(spark, sf))
    return m.withColumn("mean", rnd("mean", 8)).withColumn("std", rnd("std", 8))


def _whitened_cov(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        _, white = scaling.fit_scale(embeddings(spark, sf), kind, epsilon=1e-12)
        _, cov = mo.covariance(white)
        return mo.matrix_table(spark, cov).withColumn("value", F.round("value", 3))

    return run


IDENTITY = (
    "SELECT i::INT AS i, j::INT AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM "
    "(SELECT DISTINCT generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) a, "
    "(SELECT DISTINCT generate_subscripts(embedding, 1) - 1 AS j FROM embeddings) b"
)
for _name, _kind in (("whiten_pca_cov", "pca_whitening"), ("whiten_zca_cov", "zca_whitening")):
    catalog.queries[_name] = _whitened_cov(_kind)
    catalog.oracle[_name] = IDENTITY


@catalog.query("SELECT vec_id, embedding[1]::DOUBLE AS f_first, true AS close FROM (SELECT vec_id, " + "[round(embedding[1]::DOUBLE, 6) + 0.0]" + " AS embedding FROM embeddings)")
def whiten_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whiten, undo, compare with the input."""
    scaler, white = scaling.fit_scale(embeddings(spark, sf).withColumn("source", F.col("features")), "zca_whitening")
    back = scaling.unscale(white, scaler)
    worst = F.array_max(F.zip_with("features", "source", lambda a, b: F.abs(a - b)))
    return back.select("vec_id", rnd(F.get("features", F.lit(0))).alias("f_first"), (worst < 1e-8).alias("close"))
