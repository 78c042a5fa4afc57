"""Draws in arrays against the same hashes as expressions, their moments, and unmixing by both strategies."""

import numpy as np
import pytest
from helpers import points
from pyspark.sql import functions as F

from vectable.functions import hashing
from vectable.operators import independent, markov, mixture


def test_array_hashes_are_row_hashes(spark):
    ids = [0, 1, 7, 2**31, 2**32 + 5, 2**62, -1, -(2**40)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    for seed in (0, 5, 2**40):
        want = [r[0] for r in df.select(hashing.row_hash(F.col("id"), seed)).collect()]
        assert hashing.hash_array(hashing._seed_word(seed), np.array(ids)).tolist() == want


def test_draws_look_uniform_and_normal():
    ids = np.arange(40_000)
    u, z = hashing.uniforms(1, 0, ids), hashing.normals(1, 0, ids)
    assert 0.0 <= u.min() and u.max() < 1.0 and abs(u.mean() - 0.5) < 0.01 and abs(u.var() - 1 / 12) < 0.005
    assert abs(z.mean()) < 0.02 and abs(z.std() - 1.0) < 0.02 and abs((z**3).mean()) < 0.06
    for other in (hashing.normals(2, 0, ids), hashing.normals(1, 1, ids), hashing.normals(1, 0, ids, ids * 0), hashing.normals(1, 0, ids + 40_000)):
        assert abs(np.corrcoef(z, other)[0, 1]) < 0.02


def test_generated_rows_do_not_depend_on_partitions(spark):
    m = mixture.Mixture(np.array([0.2, 0.8]), np.array([[0.0, 0.0], [9.0, 9.0]]), np.array([[[1.0, 0.5], [0.5, 2.0]], [[1.0, 0.0], [0.0, 1.0]]]))
    rows = mixture.generate(spark, m, 4000, seed=1).collect()
    x = np.array([r.features for r in rows])
    c = np.array([r.component for r in rows])
    assert abs(c.mean() - 0.8) < 0.03
    assert np.allclose(x[c == 0].mean(0), 0.0, atol=0.15) and np.allclose(np.cov(x[c == 0].T), m.covs[0], atol=0.3)
    few = {r.row_id: r.features for r in mixture.generate(spark, m, 10, seed=1).collect()}
    assert few == {r.row_id: r.features for r in rows if r.row_id < 10}
    assert {r.component for r in mixture.generate(spark, m, 50, component=7, seed=1).collect()} == {1}


def test_generated_chains(spark):
    h = markov.Hmm("gaussian", np.array([1.0, 0.0]), np.array([[0.9, 0.1], [0.2, 0.8]]), means=np.array([[0.0], [10.0]]), covs=np.ones((2, 1, 1)))
    rows = markov.generate(spark, h, 200, 40, seed=2).collect()
    s = {(r.seq, r.t): r.state for r in rows}
    assert len(s) == 8000 and all(s[k, 0] == 0 for k in range(40))
    leave = [s[k, t + 1] for k in range(40) for t in range(199) if s[k, t] == 0]
    assert abs(np.mean(leave) - 0.1) < 0.02
    assert all(abs(r.features[0] - 10 * r.state) < 6 for r in rows)


@pytest.mark.parametrize("replicates", [1, 3])
def test_both_strategies_score_alike(spark, replicates):
    rng = np.random.default_rng(3)
    df = points(spark, rng.uniform(-1, 1, (300, 2)) @ np.array([[1.0, 0.6], [-0.4, 1.0]]))
    thetas = [k * np.pi / 2 / 23 for k in range(23)]
    w = np.array([[1.0, 0.2], [-0.3, 1.0]])
    a, b = (independent.angle_entropies(df, w, thetas, std_dev=0.1, replicates=replicates, seed=5, local_values=v) for v in (10**6, 0))
    assert np.allclose(a, b, rtol=1e-9)
    x = np.array([r.features for r in df.orderBy("row_id").collect()])
    ids = np.arange(300)
    y = [np.concatenate([x @ w[i] + 0.1 * hashing.normals(5, i, ids, np.full(300, k)) for k in range(replicates)]) for i in (0, 1)]
    for theta, e in zip(thetas, a):
        total = 0.0
        for z in (np.cos(theta) * y[0] - np.sin(theta) * y[1], np.sin(theta) * y[0] + np.cos(theta) * y[1]):
            z, m = np.sort(z), int(np.sqrt(300 * replicates))
            total += np.log(z[m:] - z[:-m]).sum()
        assert np.isclose(total, e)


def test_unmixing_at_its_defaults(spark):
    rng = np.random.default_rng(8)
    mix = np.array([[1.0, 0.6], [-0.4, 1.0]])
    m = independent.fit_unmixing(points(spark, rng.uniform(-1, 1, (1500, 2)) @ mix.T))
    total = np.abs(m.w @ mix)
    assert np.sort(total / total.max(1, keepdims=True), axis=1)[:, 0].max() < 0.05
