"""Ways of larger tables give what the plain ways give."""

import numpy as np
import pytest
from helpers import points

from vectable.functions import blocks
from vectable.operators import clustering, independent, neighbors as nb, reduction, training


def test_few_seeds_move_by_scans(spark, monkeypatch):
    """A pass over few seeds joins nothing, and rests where the join by cells rests."""
    rng = np.random.default_rng(1)
    x = np.column_stack((rng.integers(0, 5, 300), np.round(rng.uniform(-1, 9, 300), 1)))
    df = points(spark, x)
    with monkeypatch.context() as m:
        m.setattr(clustering, "FEW_SEEDS", 0)
        by_cells = clustering.mean_shift(df, 1.5, force_convergence=True)
    monkeypatch.setattr(clustering, "block_join", None)
    by_scans = clustering.mean_shift(df, 1.5, force_convergence=True)
    assert by_scans.iterations == by_cells.iterations
    a, b = ([r.features for r in m.centroids.orderBy("cluster").collect()] for m in (by_scans, by_cells))
    assert len(a) > 1 and np.allclose(a, b)


def test_radius_of_points_on_lines(spark, monkeypatch):
    """Points that share all but one feature are counted on sorted lines, copies included, and no cell is visited."""
    rng = np.random.default_rng(2)
    x = np.column_stack((rng.integers(0, 4, 400), np.round(rng.uniform(-1, 9, 400), 1)))
    x[:60] = x[0]
    want = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), axis=1)[:, 80].mean()
    monkeypatch.setattr(clustering, "rank_distances", None)
    assert abs(clustering.estimate_radius(points(spark, x)) - want) < 1e-7
    assert abs(clustering.estimate_radius(points(spark, x[:, 1:])) - np.sort(np.abs(x[:, 1:] - x[:, 1]), axis=1)[:, 80].mean()) < 1e-7


@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("k", [1, 6])
@pytest.mark.parametrize("offset", [0.0, 50.0])
def test_tiles_find_what_a_full_comparison_finds(farthest, k, offset, monkeypatch):
    """Copies, points that come nearer row by row and points far from the origin included; no full matrix is made."""
    rng = np.random.default_rng(k)
    r = rng.normal(size=(5000, 8)) + offset
    r[100:3000:7] = r[100]
    r[4000:] = r[100] + np.linspace(1.0, 0.0, 1000)[:, None]
    ids, x = np.arange(5000) * 3, np.concatenate((r[90:240], r[4500:4520], rng.normal(size=(60, 8))))
    with monkeypatch.context() as m:
        m.setattr(nb, "TILED_FROM", 10**9)
        want = nb._compared(x, r, ids, k, farthest)
    monkeypatch.setattr(nb, "sq_dists", None)
    for held in (nb.TILE_HELD, 200):
        monkeypatch.setattr(nb, "TILE_HELD", held)
        got = nb._compared(x, r, ids, k, farthest)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_blocks_grow_with_the_table(spark, monkeypatch):
    """Rows of a large table are copied to a bounded number of blocks, whatever size is asked for small ones."""
    asked = []
    join = nb.block_join
    monkeypatch.setattr(nb, "block_join", lambda *a, **o: asked.append(a[6]) or join(*a, **o))
    x = np.random.default_rng(4).normal(size=(900, 2))
    got = nb.knn(points(spark, x), points(spark, x), 2, strategy="blocks", block_rows=4, n_pivots=3).collect()
    assert asked == [900 // nb.BLOCK_COPIES]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = np.argsort(d, axis=1)[:, :2]
    assert len(got) == 1800 and all(want[r.query_id, r["rank"] - 1] == r.ref_id for r in got)


def test_entropy_by_sorted_arrays(spark):
    """Spacings across partitions, of small groups and of NULL, as a sort of every group gives them."""
    rng = np.random.default_rng(6)
    rows = [("a", float(v), i) for i, v in enumerate(rng.normal(size=900))] + [(None, float(v), i) for i, v in enumerate(np.round(rng.normal(size=50), 1))]
    rows += [("b", None, 1), ("b", None, 2), ("b", 1.0, 3), ("b", 4.0, 4), ("b", 4.5, 5), ("one", 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, z double, i int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.g: (r.n, r.entropy) for r in independent.spacing_entropy(df, "z", ["i"], "g").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == {"a", None, "b"}
    for g in ("a", None):
        z = np.sort([r[1] for r in rows if r[0] == g])
        m = int(np.sqrt(len(z)))
        assert got[g][0] == len(z) and np.isclose(got[g][1], np.log(np.maximum(z[m:] - z[:-m], independent.TINY)).sum(), rtol=1e-12)
    # NULL, NULL, 1, 4, 4.5 with m = 2.
    assert got["b"][0] == 5 and np.isclose(got["b"][1], 2 * np.log(independent.TINY) + np.log(3.5))


def test_logarithms_by_products():
    x = np.concatenate((np.random.default_rng(7).exponential(size=1000) ** 9, [independent.TINY, 1e300, 1.0]))
    for n in (0, 1, 31, 32, 1003):
        assert np.isclose(independent.log_sum(x[:n]), np.log(x[:n]).sum(), rtol=1e-12)


def test_full_gradients_read_packed_blocks(spark, monkeypatch):
    """Passes of a fit convert no rows, and see all of them with their kinds."""
    x = np.random.default_rng(8).normal(size=(500, 3))
    df = points(spark, x, label=np.arange(500) % 3)
    monkeypatch.setattr(blocks, "PACKED_ROWS", 60)
    with blocks.packed(df, ["features", "label"]) as kept:
        seen = blocks.sum_over_rows(kept, [], lambda f, y: {"s": f[y == 1].sum(0), "n": np.array(float(len(y) * (y.dtype.kind == "i")))})
    assert np.allclose(seen["s"], x[np.arange(500) % 3 == 1].sum(0)) and seen["n"] == 500
    taken = []
    monkeypatch.setattr(training, "mean_objective", lambda source, *a: taken.append(type(source)) or (lambda t: (float(t @ t), 2 * t)))
    training.minimise(df, ["features"], np.ones(2), None, None, optimizer="lbfgs", max_iterations=2, tolerance=1e-9)
    assert taken == [blocks.Packed]


def test_cosine_tree_reads_packed_blocks(spark, monkeypatch):
    """No round converts rows, and blocks of any size give one tree."""
    rng = np.random.default_rng(9)
    x = np.concatenate((rng.normal(size=(20, 6))[rng.integers(0, 20, 600)] * 3 + rng.normal(size=(600, 6)) * 0.2, np.ones((30, 6))))
    df, found = points(spark, x), []
    monkeypatch.setattr(reduction, "reused", None)
    for size in (1 << 15, 50):
        monkeypatch.setattr(blocks, "PACKED_ROWS", size)
        found.append(reduction.cosine_tree(df, x.mean(0), np.ones(6), 0.2, "row_id", 1))
    (a, left), (b, left_b) = found
    assert np.allclose(a @ a.T, b @ b.T) and np.isclose(left, left_b) and left <= 0.2
    z = x - x.mean(0)
    assert np.isclose(left, ((z - z @ a @ a.T) ** 2).sum() / (z**2).sum())
