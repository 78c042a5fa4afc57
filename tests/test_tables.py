"""Layouts, order statistics, splits, lookups, appends, scalers: edge cases."""

import numpy as np
import pytest
from helpers import points
from pyspark.sql import functions as F

from vectable.functions import exprs, hashing
from vectable.operators import append, joins, layout, lookup, order, scaling, split
from vectable.sources.text import load


def test_layout_round_trips(spark):
    df = points(spark, np.arange(12.0).reshape(4, 3))
    want = sorted(map(tuple, (r["features"] for r in df.collect())))
    for path in (["vector", "long", "vector"], ["vector", "wide", "vector"], ["vector", "long", "wide", "long", "vector"]):
        out = df
        for a, b in zip(path, path[1:]):
            out = layout.convert(out, a, b, dim=3, feature_cols=["f0", "f1", "f2"])
        assert sorted(tuple(r["features"]) for r in out.collect()) == want
    assert layout.convert(df, "vector", "vector") is df
    with pytest.raises(ValueError):
        layout.convert(df, "vector", "cube")


def test_shape_checks(spark):
    ragged = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "row_id bigint, features array<double>")
    with pytest.raises(ValueError):
        layout.shape(ragged)
    holes = spark.createDataFrame([(0, [1.0, None]), (1, [1.0, float("nan")]), (2, [1.0, 2.0]), (3, None)], "row_id bigint, features array<double>")
    assert [r["row_id"] for r in layout.drop_invalid(holes).collect()] == [2]
    with pytest.raises(Exception, match="fitted length"):
        layout.require_dim(ragged, 2).collect()
    assert layout.shape(ragged.limit(0)) == (0, 0)


@pytest.mark.parametrize("labels,ok", [([0, 1, 2], True), ([0, 2], False), ([1, 2], False)])
def test_label_contiguity(spark, labels, ok):
    df = spark.createDataFrame([(v,) for v in labels * 3], "label int")
    assert layout.label_summary(df).first()["contiguous"] is ok
    if not ok:
        with pytest.raises(ValueError):
            layout.require_contiguous_labels(df)


def test_nth_smallest_is_exact(spark):
    values = np.random.default_rng(1).integers(-(10**12), 10**12, 500)
    values[:170] = 77
    df = spark.createDataFrame([(int(v),) for v in values], "v bigint")
    ranked = np.sort(values)
    for r in (0, 1, 250, 260, 499):
        value, below = order.nth_smallest(df, F.col("v"), r)
        assert value == ranked[r] and below == (values < value).sum()
    with pytest.raises(ValueError):
        order.nth_smallest(df, F.col("v"), 500)


def test_running_totals_with_one_heavy_group(spark):
    rng = np.random.default_rng(2)
    rows = [(0 if i % 3 else int(rng.integers(1, 9)), i, float(rng.integers(0, 9))) for i in range(3000)]
    df = spark.createDataFrame(rows, "g bigint, t bigint, v double").repartition(7)
    got = {(r["g"], r["t"]): (r["n"], r["s"]) for r in order.running_totals(df, ["g"], ["t"], {"n": None, "s": "v"}).collect()}
    seen: dict = {}
    for g, t, v in sorted(rows):
        n, s = seen.get(g, (0, 0.0))
        seen[g] = (n + 1, s + v)
        assert got[g, t] == seen[g]
    assert len(got) == len(rows)


def test_running_totals_with_null_groups_and_strings(spark):
    rows = [(None, 1), ("a", 2), (None, 3), ("a", 4), ("b", 5)]
    df = spark.createDataFrame(rows, "g string, t bigint")
    got = {(r["g"], r["t"]): r["pos"] for r in order.sequence_position(df, ["g"], ["t"]).collect()}
    assert got == {(None, 1): 0, (None, 3): 1, ("a", 2): 0, ("a", 4): 1, ("b", 5): 0}


def test_result_does_not_depend_on_partitions(spark):
    df = points(spark, np.random.default_rng(3).normal(size=(200, 2)))
    ids = []
    for n in (1, 8):
        test = split.split(df.repartition(n), 0.25, seed=4)[1]
        ids.append(sorted(r["row_id"] for r in test.collect()))
    assert ids[0] == ids[1] and len(ids[0]) == 50


@pytest.mark.parametrize("ratio,count", [(0.0, 0), (1.0, 20), (-1.0, 0), (0.33, 6)])
def test_split_sizes(spark, ratio, count):
    df = points(spark, np.zeros((20, 1)))
    for shuffle in (True, False):
        train, test = split.split(df, ratio, shuffle=shuffle)
        assert (train.count(), test.count()) == (20 - count, count)


def test_split_needs_matching_labels(spark):
    df = points(spark, np.zeros((5, 1)))
    with pytest.raises(ValueError):
        split.split_with_labels(df, spark.range(4).select(F.col("id").alias("row_id"), F.lit(1).alias("label")))


def test_lookup_with_heavy_key_keeps_every_row(spark, monkeypatch):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 10**6).otherwise(F.col("id") % 50).alias("idx"), F.col("id").alias("q"))
    data = points(spark, np.arange(50.0)[:, None])
    out = lookup.lookup(left, data)
    assert out.count() == 3000
    heavy = joins.join_unique(left.withColumn("row_id", layout.clamp_index(F.col("idx"), 50)), data, "row_id", min_rows=10)
    assert sorted((r["q"], r["row_id"]) for r in heavy.collect()) == sorted((r["q"], r["row_id"]) for r in out.collect())


def test_append_offsets_and_reset(spark):
    a, b, other = points(spark, np.zeros((3, 1))), points(spark, np.ones((2, 1))), spark.range(2).withColumnRenamed("id", "row_id")
    assert sorted(r["row_id"] for r in append.append_rows([a, b, a]).collect()) == list(range(8))
    assert append.append_rows([a, other, other]).count() == 4


def test_constant_feature_scales_to_itself(spark):
    df = points(spark, np.array([[1.0, 5.0], [3.0, 5.0]]))
    for kind in ("standard", "min_max", "normalization", "abs"):
        scaler, out = scaling.fit_scale(df, kind)
        values = np.array([r["features"] for r in out.orderBy("row_id").collect()])
        assert np.isfinite(values).all()
        back = scaling.unscale(out, scaler)
        assert np.allclose([r["features"] for r in back.orderBy("row_id").collect()], [[1.0, 5.0], [3.0, 5.0]])
    assert np.allclose(scaling.scale_matrix(scaler, scaling.scale_matrix(scaler, np.eye(2)), inverse=True), np.eye(2))


def test_changed_scaler_needs_a_new_fit(spark):
    df = points(spark, np.array([[1.0], [2.0]]))
    slot = scaling.ScalerSlot("standard")
    with pytest.raises(ValueError):
        slot.transform(df)
    slot.fit(df)
    slot.transform(df).collect()
    slot.set_kind("abs")
    with pytest.raises(ValueError):
        slot.transform(df)


def test_wide_vectors_use_the_same_formulas(spark):
    x = np.random.default_rng(5).normal(size=(3, 300))
    df = points(spark, x)
    w = np.linspace(-1, 1, 300)
    got = df.select("row_id", exprs.linear("features", w, 0.5).alias("y"), exprs.affine("features", w, w + 2).alias("z")).orderBy("row_id").collect()
    assert np.allclose([r["y"] for r in got], x @ w + 0.5)
    assert np.allclose([r["z"] for r in got], (x - w) * (w + 2))


@pytest.mark.parametrize("name", exprs.TAPERS)
def test_taper_forms_agree(spark, name):
    got = [r[0] for r in spark.range(16).orderBy("id").select(exprs.taper(name, F.col("id").cast("int"), 16)).collect()]
    assert np.allclose(got, exprs.taper_values(name, 16))


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 5.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        exprs.sq_distance(a, b).alias("q"), exprs.distance(a, b).alias("d"), exprs.dot(a, b).alias("p"), exprs.vector_add(a, b).alias("s"),
        exprs.vector_multiply(a, b).alias("m"), exprs.vector_scale(a, 2.0).alias("k"), exprs.log_softmax(a).alias("l"),
        exprs.neighbourhood(F.lit(4.0), 2.0).alias("h"), exprs.decay(2.0, F.lit(1.0), 1.0).alias("e"),
    ).first()
    assert row["q"] == 13.0 and np.isclose(row["d"], 13.0**0.5) and row["p"] == 13.0
    assert row["s"] == [4.0, 7.0] and row["m"] == [3.0, 10.0] and row["k"] == [2.0, 4.0]
    assert np.allclose(row["l"], np.array([1.0, 2.0]) - 2.0 - np.log(1 + np.exp(-1.0)))
    assert np.isclose(row["h"], np.exp(-0.5)) and np.isclose(row["e"], 2.0 * np.exp(-1.0))


def test_load_numbers_lines_across_files_and_rejects_bad_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\n3,4\n\n5,6")
    (tmp_path / "b.csv").write_text("7,8\n")
    (tmp_path / "c.csv").write_text("1,x\n")
    got = load(spark, str(tmp_path / "a.csv")).orderBy("row_id").collect()
    assert [(r["row_id"], r["features"]) for r in got] == [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])]
    columns = load(spark, str(tmp_path / "a.csv"), transposed=False).orderBy("row_id").collect()
    assert [r["features"] for r in columns] == [[1.0, 3.0, 5.0], [2.0, 4.0, 6.0]]
    wide = load(spark, str(tmp_path / "b.csv"), layout="wide")
    assert wide.columns == ["row_id", "f0", "f1"]
    with pytest.raises(Exception):
        load(spark, str(tmp_path / "c.csv")).collect()
    with pytest.raises(ValueError):
        load(spark, str(tmp_path / "a"))


def test_rows_without_an_id_are_training_rows(spark):
    df = spark.createDataFrame([(k,) for k in range(10)] + [(None,), (None,)], "row_id bigint")
    for shuffle in (True, False):
        for ratio in (0.0, 0.3, 1.0):
            train, test = split.split(df, ratio, shuffle=shuffle)
            assert (train.count(), test.count()) == (12 - int(10 * ratio), int(10 * ratio))
            assert test.filter("row_id is null").count() == 0


def test_running_totals_keep_groups_apart(spark):
    nan = float("nan")
    rows = [(0, 0, nan), (0, 1, 1.0), (1, 0, 1e17), (1, 1, 2.0), (2, 0, 1.0), (2, 1, 1.0), (3, 0, 0.5)]
    df = spark.createDataFrame(rows, "g int, t int, v double").coalesce(1)
    got = {(r.g, r.t): r.s for r in order.running_totals(df, ["g"], ["t"], {"s": "v"}).collect()}
    assert got[0, 0] != got[0, 0] and got[0, 1] != got[0, 1]
    assert [got[2, 0], got[2, 1], got[3, 0]] == [1.0, 2.0, 0.5]


def test_near_seeds_give_unrelated_hashes(spark):
    ids = spark.range(2000)
    a, b, c = ([r[0] for r in ids.select(hashing.row_hash(F.col("id") + shift, seed)).collect()] for shift, seed in ((0, 0), (0, 1), (2**32, 0)))
    assert len(set(a) & set(b)) < 5
    assert sum(x == y for x, y in zip(a, c)) < 5
