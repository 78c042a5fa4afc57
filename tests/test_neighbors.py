"""Neighbour joins against brute force, with copies and one heavy region."""

import numpy as np
import pytest
from helpers import points

from vectable.operators import neighbors as nb


def brute(x, r, k, farthest=False, skip_self=False):
    out = {}
    d = np.sqrt(((x[:, None] - r[None]) ** 2).sum(2))
    for i in range(len(x)):
        rows = [(-d[i, j] if farthest else d[i, j], j) for j in range(len(r)) if not (skip_self and i == j)]
        out[i] = [(j, round(abs(v), 9)) for v, j in sorted(rows)[:k]]
    return out


def result(df):
    out = {}
    for q, rank, ref, dist in sorted(tuple(r) for r in df.select("query_id", "rank", "ref_id", "dist").collect()):
        out.setdefault(q, []).append((ref, round(dist, 9)))
        assert rank == len(out[q])
    return out


def skewed(rng, n, d):
    """A third of all rows are copies of one point, another third lies in one dense spot."""
    x = rng.normal(size=(n, d))
    x[: n // 3] = 0.5
    x[n // 3 : 2 * n // 3] *= 0.01
    return x[rng.permutation(n)]


@pytest.mark.parametrize("d", [1, 2, 8])
@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("strategy", ["broadcast", "blocks"])
def test_matches_brute_force(spark, d, farthest, strategy):
    rng = np.random.default_rng(d)
    r, x = skewed(rng, 150, d), skewed(rng, 60, d)
    got = nb.neighbour_join(points(spark, x), points(spark, r), 4, farthest=farthest, strategy=strategy, n_pivots=7, block_rows=16)
    assert result(got) == brute(x, r, 4, farthest)


def test_exclude_self_with_copies(spark):
    x = skewed(np.random.default_rng(9), 90, 3)
    df = points(spark, x)
    for strategy in ("broadcast", "blocks"):
        got = nb.neighbour_join(df, df, 3, exclude_self=True, strategy=strategy, n_pivots=4, block_rows=16)
        assert result(got) == brute(x, x, 3, skip_self=True)


def test_k_limits(spark):
    df = points(spark, np.arange(6.0)[:, None])
    assert nb.knn(df, df, 6).count() == 36
    assert nb.knn(df, df, 6, strategy="blocks", n_pivots=2).count() == 36
    with pytest.raises(ValueError):
        nb.knn(df, df, 7)
    with pytest.raises(ValueError):
        nb.knn(df, df, 6, exclude_self=True)
    with pytest.raises(ValueError):
        nb.knn(df, df, 0)
    with pytest.raises(ValueError):
        nb.kfn(df, df, 1, percentage=0.0)


def test_broadcast_limit_is_enforced(spark):
    df = points(spark, np.arange(6.0)[:, None])
    with pytest.raises(ValueError):
        nb.knn(df, df, 1, strategy="broadcast", broadcast_bytes=10)
    assert nb.knn(df, df, 1, broadcast_bytes=10).count() == 6  # falls over to blocks


def test_approximate_bounds(spark):
    rng = np.random.default_rng(11)
    x, r = rng.normal(size=(40, 2)), rng.normal(size=(400, 2))
    q, ref = points(spark, x), points(spark, r)
    exact, far = brute(x, r, 3), brute(x, r, 3, True)
    near = result(nb.knn(q, ref, 3, epsilon=0.5, n_pivots=20))
    away = result(nb.kfn(q, ref, 3, percentage=0.7, n_pivots=20))
    for i in range(40):
        assert all(a[1] <= 1.5 * b[1] + 1e-9 for a, b in zip(near[i], exact[i]))
        assert all(a[1] >= 0.7 * b[1] - 1e-9 for a, b in zip(away[i], far[i]))
    greedy = result(nb.knn(q, ref, 3, greedy=True, tau=0.1, n_pivots=20))
    assert all(len(v) == 3 for v in greedy.values()) and len(greedy) == 40


def test_best_match_first_wins(spark):
    df = points(spark, np.array([[0.0], [1.0], [2.0]]))
    got = nb.best_match(df, np.array([[1.0], [1.0], [3.0]])).orderBy("row_id").collect()
    assert [r["bmu"]["node"] for r in got] == [0, 0, 0]
    assert [r["bmu"]["sq_dist"] for r in got] == [1.0, 0.0, 1.0]


@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("k", [1, 3, 5])
def test_one_feature_is_searched_in_order(farthest, k, monkeypatch):
    """Points of one feature are found without comparing all, copies and equal distances to either side included."""
    rng = np.random.default_rng(k)
    r, ids = np.round(rng.normal(size=(400, 1)), 1), rng.permutation(400)
    r, ids = r[np.argsort(ids)], np.sort(ids)
    x = np.concatenate((np.round(rng.normal(size=(80, 1)), 2), [[1e9], [-1e9], [0.05], [1e-200]]))
    want = nb._compared(x, r, ids, k, farthest)
    compared = []
    monkeypatch.setattr(nb, "sq_dists", lambda a, b: compared.append(len(b)) or np.zeros((len(a), len(b))))
    got = nb.top_k(x, r, ids, k, farthest)
    assert not compared
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
