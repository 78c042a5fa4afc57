"""Jobs that grew too slow or too large for their disk give what the plain ways give, in fewer steps."""

import numpy as np
import pyarrow as pa
import pytest
from helpers import points
from pyspark.sql import functions as F

from vectable.operators import buckets, clustering, independent, neighbors as nb, radius


@pytest.mark.parametrize("limit", [1000, 2])
def test_seeds_of_a_mean_shift_move_in_one_job(spark, monkeypatch, limit):
    """Without a pass over the table for each step, also where steps are limited; copies weigh as many rows."""
    rng = np.random.default_rng(5)
    x = np.column_stack((rng.integers(0, 5, 400), np.round(rng.uniform(-1, 9, 400), 1)))
    x[:50] = x[0]
    df = points(spark, x)
    with monkeypatch.context() as m:
        m.setattr(clustering, "FEW_SEEDS", 0)
        by_cells = clustering.mean_shift(df, 1.5, max_iterations=limit)
    with monkeypatch.context() as m:
        m.setattr(clustering, "BROADCAST_BYTES", 0, raising=False)
        by_scans = clustering.mean_shift(df, 1.5, max_iterations=limit)
    monkeypatch.setattr(clustering, "_moved", None)
    held = clustering.mean_shift(df, 1.5, max_iterations=limit)
    assert held.iterations == by_scans.iterations == by_cells.iterations
    a, b, c = ([r.features for r in m.centroids.orderBy("cluster").collect()] for m in (held, by_scans, by_cells))
    assert len(a) > 1 and np.allclose(a, b) and np.allclose(a, c)


@pytest.mark.parametrize("k", [1, 6, 40])
@pytest.mark.parametrize("d", [2, 4])
def test_boxes_find_what_a_full_comparison_finds(d, k, monkeypatch):
    """Copies, points on lines, equal distances and queries far outside included; no full matrix is made."""
    rng = np.random.default_rng(d + k)
    r = rng.normal(size=(3000, d))
    r[:, 0] = np.round(r[:, 0])
    r[:700], r[1000:1400] = r[0], np.round(r[1000:1400])
    ids, x = np.arange(3000) * 3, np.concatenate((r[600:1100], rng.normal(size=(100, d)) * 20, r[1000:1010] + 0.5))
    with monkeypatch.context() as m:
        m.setattr(nb, "BOXED_FROM", 10**9, raising=False)
        want = nb._compared(x, r, ids, k, False)
    monkeypatch.setattr(nb, "sq_dists", None)
    got = nb._compared(x, r, ids, k, False)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_small_reference_of_few_features_is_searched_by_boxes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    df = points(spark, np.column_stack((rng.integers(0, 9, 1500), rng.normal(size=1500), rng.normal(size=1500))))
    want = nb.knn(df, df, 3, exclude_self=True, strategy="blocks", n_pivots=4).collect()
    monkeypatch.setattr(nb, "_compared", None)
    got = nb.knn(df, df, 3, exclude_self=True).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want)


def test_rows_of_many_buckets_are_not_sorted_to_meet_their_loads(spark, monkeypatch):
    """Only the full buckets are looked up; every pair of a bucket still meets once."""
    def rows(name: str):
        return spark.range(4000).select(F.when(F.col("id") < 300, F.lit(-1)).otherwise(F.col("id") % 50).cast("bigint").alias("t"), F.col("id").alias(name))

    monkeypatch.setattr(buckets, "LOAD_ROWS", 10)
    monkeypatch.setattr(buckets, "CALL_ROWS", 500, raising=False)

    def work(q: pa.Table, r: pa.Table) -> pa.Table:
        a, b = np.meshgrid(q["v"].to_numpy(), r["w"].to_numpy())
        return pa.table({"v": a.reshape(-1), "w": b.reshape(-1)})

    query, ref = rows("v").where("t <> 9"), rows("w").where("w % 3 = 0 AND t <> 7")
    met = buckets.bucket_join(query, ref, ["t"], work, "v bigint, w bigint", 100)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    want = query.join(ref, "t").select("v", "w")
    assert met.count() == want.count() and met.exceptAll(want).isEmpty()


def test_radius_join_copies_the_smaller_side(spark, monkeypatch):
    """A full cell is not cut into blocks of a call's size, and only the side with fewer rows visits the cells next to its own."""
    sides = []

    def dealt(query, ref, *rest, **more):
        sides.append((query.count(), ref.count()))
        return join(query, ref, *rest, **more)

    join = radius.bucket_join
    monkeypatch.setattr(radius, "bucket_join", dealt)
    monkeypatch.setattr(radius, "JOIN_PAIRS", 1000)
    rng = np.random.default_rng(4)
    x, y = np.round(rng.uniform(0, 5, (900, 1)), 2), np.round(rng.uniform(0, 5, (60, 1)), 2)
    many, few = points(spark, x), points(spark, y)
    want = {(i, j) for i, j in zip(*np.nonzero(np.abs(x - y.T) <= 0.75))}
    shuffled = buckets._streamed
    copies = []
    monkeypatch.setattr(buckets, "_streamed", lambda left, right, *rest: copies.append((left.count(), right.count())) or shuffled(left, right, *rest))
    got = {(r.query_id, r.ref_id): r.dist for r in radius.radius_join(many, few, 0.75).collect()}
    turned = {(r.ref_id, r.query_id): r.dist for r in radius.radius_join(few, many, 0.75).collect()}
    assert set(got) == want and got == turned and all(abs(d - abs(x[i, 0] - y[j, 0])) < 1e-12 for (i, j), d in got.items())
    assert sides == [(900, 180), (180, 900)]
    assert all(a + b <= 1080 for a, b in copies)


@pytest.mark.parametrize("farthest", [False, True])
def test_products_exchange_only_the_best(spark, monkeypatch, farthest):
    """In many dimensions blocks meet blocks; queries and points are not copied for cells, and ties go to the lower id."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 16))
    x[:40] = x[0]
    df = points(spark, x).repartition(3)
    want = nb.neighbour_join(df, df, 3, farthest=farthest, exclude_self=True).collect()
    monkeypatch.setattr(nb, "block_join", None)
    monkeypatch.setattr(nb, "BROADCAST_BYTES", 10_000)
    got = nb.neighbour_join(df, df, 3, farthest=farthest, exclude_self=True, broadcast_bytes=10_000, block_rows=70)
    assert "CartesianProduct" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want)


def test_cells_are_kept_where_they_exclude(spark, monkeypatch):
    """Points of few features still go to the cells that their queries visit."""
    rng = np.random.default_rng(8)
    df = points(spark, rng.uniform(size=(3000, 2)))
    want = nb.knn(df, df, 2).collect()
    monkeypatch.setattr(nb, "_multiplied", None, raising=False)
    got = nb.knn(df, df, 2, broadcast_bytes=1000).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want)


@pytest.mark.parametrize("std_dev", [0.175, 0.0])
def test_replicas_are_exchanged_a_few_slices_at_a_time(spark, monkeypatch, std_dev):
    """Scores are those of one task that sorts all replicas, ties and slices shorter than a spacing included."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 2))
    x[:120] = x[0]
    df, thetas = points(spark, x), [0.0, 0.4, 1.1]
    more = dict(std_dev=std_dev, replicates=5, seed=3)
    want = independent.angle_entropies(df, np.eye(2), thetas, **more)
    rounds, split = [], getattr(independent, "_rounds", None)
    monkeypatch.setattr(independent, "spacing_entropy", None)
    for exchanged, size in ((400, 100), (400, 20), (4000, 100), (10**9, 10**6)):
        monkeypatch.setattr(independent, "EXCHANGED_VALUES", exchanged, raising=False)
        monkeypatch.setattr(independent, "SLICE_VALUES", size, raising=False)
        monkeypatch.setattr(independent, "_rounds", lambda *a: rounds.extend(split(*a)) or split(*a), raising=False)
        got = independent.angle_entropies(df, np.eye(2), thetas, local_values=0, **more)
        assert np.allclose(got, want, rtol=1e-9)
        slices = -(-1500 // size)
        assert max(sum(hi - lo for _, lo, hi in parts) for parts in rounds) * 1500 <= max(exchanged, size) * slices
        assert sorted(i for parts in rounds for g, lo, hi in parts for i in range(g * slices + lo, g * slices + hi)) == list(range(6 * slices))
        rounds.clear()
