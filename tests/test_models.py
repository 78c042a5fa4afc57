"""Fitted models on small known data."""

import numpy as np
import pytest
from helpers import blobs, points
from pyspark.sql import functions as F

from vectable.operators import clustering as cl, independent as ica, linear as li, mixture as gm, neural as nn, reduction as rd, som, svm
from vectable.operators import scaling, training as tn, trees as tr
from vectable.operators.training import lbfgs
from vectable.sources.models import load_model, save_model


def purity(found, truth):
    return sum(np.bincount(truth[found == c]).max() for c in np.unique(found)) / len(truth)


@pytest.fixture(scope="module")
def three(spark):
    x, y = blobs(np.random.default_rng(0))
    df = points(spark, x, label=y).persist()
    yield x, y, df
    df.unpersist()


def column(df, name):
    return np.array([r[name] for r in df.orderBy("row_id").select(name).collect()])


@pytest.mark.parametrize("refined", [False, True])
def test_kmeans_finds_blobs(three, refined):
    _, y, df = three
    m = cl.kmeans(df, 3, refined=refined, samplings=6, percentage=0.3, seed=3)
    assert m.converged
    if refined:
        assert purity(column(cl.assign(df, m.centroids), "cluster"), y) == 1.0


def test_kmeans_errors(three):
    _, _, df = three
    with pytest.raises(ValueError):
        cl.kmeans(df, 0)
    with pytest.raises(ValueError):
        cl.kmeans(df, 1000)
    with pytest.raises(ValueError):
        cl.kmeans(df, 3, centroids=np.zeros((2, 2)))
    with pytest.raises(ValueError):
        cl.kmeans(df, 50, refined=True, percentage=0.02)


def test_mean_shift_finds_blobs(three):
    _, y, df = three
    m = cl.mean_shift(df, 3.0)
    assert m.centroids.count() == 3
    got = cl.mean_shift_assign(df, m)
    assert purity(column(got, "cluster"), y) == 1.0
    away = points(df.sparkSession, np.array([[100.0, 100.0], [0.0, 0.0]]))
    loose = [r["cluster"] for r in cl.mean_shift_assign(away, m, beyond_radius=False).orderBy("row_id").collect()]
    assert loose[0] is None and loose[1] is not None
    x = np.array([r["features"] for r in df.orderBy("row_id").collect()])
    d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 1)
    assert abs(cl.estimate_radius(df) - d[:, int(0.2 * len(x))].mean()) < 1e-6
    assert cl.mean_shift(df, 3.0, max_iterations=1, force_convergence=True).iterations > 1
    assert cl.mean_shift(df, 3.0, max_iterations=1).centroids.count() >= 3


def test_tree_depth_is_refused_not_cut(three):
    for depth in (0, 31):
        with pytest.raises(ValueError):
            tr.fit_tree(three[2], maximum_depth=depth)


def test_shift_matches_brute_force_with_copies(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 2))
    x[:40] = 0.25
    df = points(spark, x)
    distinct = cl.distinct_points(df)
    cells, placed = cl.fit_cells(distinct, distinct.count(), 1, n_pivots=6)
    seeds = cl.bin_seeds(df, 0.8)
    got = cl.shift_once(seeds, cells, placed, 0.8).join(seeds, "_q").collect()
    assert got
    for r in got:
        near = ((x - np.array(r["_qx"])) ** 2).sum(1) <= 0.64
        assert r["count"] == near.sum() and np.allclose(r["center"], x[near].mean(0))


@pytest.mark.parametrize("diagonal", [True, False])
def test_mixture(spark, three, diagonal):
    _, y, df = three
    m = gm.fit_mixture(df, 3, diagonal_covariance=diagonal, trials=3, seed=1)
    assert purity(column(gm.classify(df, m), "component"), y) > 0.98
    shift = m.means.mean(0)
    one = gm.em_step(df, m, shift)
    assert gm.em_step(df, one, shift).loglik >= one.loglik - 1e-6
    g = gm.generate(spark, m, 4000, seed=2)
    means = {r["component"]: np.array([r["x"], r["y"]]) for r in g.groupBy("component").agg(F.avg(F.get("features", F.lit(0))).alias("x"), F.avg(F.get("features", F.lit(1))).alias("y")).collect()}
    assert all(np.abs(means[c] - m.means[c]).max() < 0.15 for c in means) and len(means) == 3
    only = gm.generate(spark, m, 50, component=99, seed=2)
    assert [r["component"] for r in only.select("component").distinct().collect()] == [2]
    weighted = gm.generate(spark, m, 300, weights=[0, 1, 0], seed=2)
    assert [r["component"] for r in weighted.select("component").distinct().collect()] == [1]


def test_generated_points_return_to_the_training_scale(spark, three):
    x, _, df = three
    fitted = scaling.fit_autoscaled(df, lambda d: gm.fit_mixture(d, 3, max_iterations=3))
    drawn = scaling.restore_autoscaled(gm.generate(spark, fitted.model, 2000, seed=1), fitted)
    mean = drawn.agg(*[F.avg(F.get("features", F.lit(i))).alias(f"m{i}") for i in range(2)]).first()
    assert np.allclose([mean["m0"], mean["m1"]], x.mean(0), atol=0.4)


def test_mixture_errors(three):
    _, _, df = three
    with pytest.raises(ValueError):
        gm.fit_mixture(df, 1000)
    with pytest.raises(ValueError):
        gm.normalised_weights([1.0, 2.0], 3)
    assert np.allclose(gm.normalised_weights(None, 4), 0.25)


def test_som(three):
    _, _, df = three
    m = som.train_som(df, 4, 4, epochs=5, initialization="sample")
    err = nb_error(df, m.nodes)
    assert err < 1.5
    online = som.train_som(df, 4, 4, epochs=5, initialization="gaussian", batch_process=False, learning_rate=0.05)
    assert np.isfinite(online.nodes).all()
    assert som.radius_at(8, 8, 0, 0, 5) == 4.0 and som.radius_at(8, 8, 2, 0, 5) == 2.0 and som.radius_at(1, 1, 0, 3, 5) == 1.0


def nb_error(df, nodes):
    from vectable.operators.neighbors import best_match

    return best_match(df, nodes).agg(F.avg("bmu.sq_dist")).first()[0]


def test_pca_methods(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 12)) + 0.01 * rng.normal(size=(300, 12))
    df = points(spark, x)
    exact = rd.fit_pca(df, 3)
    assert exact.retained > 0.999
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(exact.values, values.clip(0))
    for method in rd.METHODS[1:]:
        approx = rd.fit_pca(df, 3, method=method, epsilon=1e-9)
        assert np.allclose(approx.values[:3], values[:3], rtol=1e-6)
    scores = np.array([r["scores"] for r in rd.pca_scores(df, exact).orderBy("row_id").collect()])
    assert np.allclose(np.abs(scores), np.abs((x - x.mean(0)) @ np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :3]), atol=1e-8)
    with pytest.raises(ValueError):
        rd.fit_pca(df, 13)


def test_nmf_recovers_low_rank(spark):
    rng = np.random.default_rng(7)
    v = rng.random((80, 2)) @ rng.random((2, 6))
    df = points(spark, v)
    m = rd.fit_nmf(df, 2, max_iterations=200, tolerance=1e-9)
    w = np.array([r["w"] for r in rd.nmf_rows(df, m).orderBy("row_id").collect()])
    assert (w >= 0).all() and (m.h >= 0).all()
    assert np.abs(w @ m.h - v).max() < 0.05
    assert abs(m.residue - np.sqrt(((w @ m.h - v) ** 2).mean())) < 1e-2
    with pytest.raises(ValueError):
        rd.fit_nmf(points(spark, -v), 2)


def test_unmixing_separates_uniform_sources(spark):
    rng = np.random.default_rng(8)
    s = rng.uniform(-1, 1, (1500, 2))
    mix = np.array([[1.0, 0.6], [-0.4, 1.0]])
    m = ica.fit_unmixing(points(spark, s @ mix.T), replicates=2, angles=36, std_dev=0.1)
    total = np.abs(m.w @ mix)
    total /= total.max(1, keepdims=True)
    assert np.sort(total, axis=1)[:, 0].max() < 0.12


@pytest.mark.parametrize("epsilon", [0.5, 0.1, 0.01, 1e-6])
def test_cosine_tree_holds_its_bound(spark, epsilon):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 12)) + 0.05 * rng.normal(size=(300, 12))
    x[:100] = x[0]
    df = points(spark, x)
    z = x - x.mean(0)
    basis, outside = rd.cosine_tree(df, x.mean(0), np.ones(12), epsilon, "row_id", 1)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-9)
    left = ((z - z @ basis @ basis.T) ** 2).sum() / (z * z).sum()
    assert np.isclose(left, outside, atol=1e-9) and (left <= epsilon or basis.shape[1] == 12)
    exact, found = rd.fit_pca(df, 2), rd.fit_pca(df, 2, method="quic", epsilon=epsilon)
    assert exact.retained - epsilon - 1e-9 <= found.retained <= exact.retained + 1e-9
    if epsilon >= 0.01:
        assert found.basis < 12


def test_cosine_tree_of_odd_tables(spark):
    same = points(spark, np.ones((5, 3)))
    assert rd.fit_pca(same, 2, method="quic").vectors.shape == (3, 2)
    line = points(spark, np.outer(np.arange(7.0), [1.0, 2.0]))
    found = rd.fit_pca(line, 1, method="quic")
    assert found.basis <= 2 and np.isclose(found.retained, 1.0)
    with pytest.raises(ValueError):
        rd.fit_pca(line, 1, method="quic", epsilon=0.0)


def test_linear_and_ridge(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(5, 2, (200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3.0 + 0.1 * rng.normal(size=200)
    df = points(spark, x, target=y)
    z = np.hstack([np.ones((200, 1)), x])
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    m = li.fit_linear(df)
    assert np.allclose([m.intercept, *m.coefficients], beta) and np.isclose(m.mse, ((z @ beta - y) ** 2).mean())
    c = x - x.mean(0)
    ridge = np.linalg.solve(c.T @ c + 50 * np.eye(3), c.T @ (y - y.mean()))
    assert np.allclose(li.fit_linear(df, lam=50.0).coefficients, ridge)
    with pytest.raises(ValueError):
        li.fit_linear(df, lam=-1.0)


def test_lbfgs_on_a_quadratic():
    a = np.diag([1.0, 10.0, 100.0])
    x, value, _ = lbfgs(lambda t: (0.5 * t @ a @ t, a @ t), np.ones(3), 200, 1e-12)
    assert np.abs(x).max() < 1e-5 and value < 1e-10


def numeric_gradient(f, theta, h=1e-5):
    out = np.zeros_like(theta)
    for i in range(len(theta)):
        e = np.zeros_like(theta)
        e[i] = h
        out[i] = (f(theta + e) - f(theta - e)) / (2 * h)
    return out


@pytest.mark.parametrize("name", sorted(nn.ACTIVATIONS))
@pytest.mark.parametrize("classifier", [True, False])
def test_network_gradient(name, classifier):
    rng = np.random.default_rng(10)
    net = nn.start_network((3, 4, 2), name, classifier, 1)
    x = rng.normal(size=(7, 3))
    y = rng.integers(0, 2, 7) if classifier else rng.normal(size=(7, 2))
    loss = nn._row_loss(net)
    assert np.allclose(loss(net.theta, x, y)[1], numeric_gradient(lambda t: loss(t, x, y)[0], net.theta), atol=1e-5)


def test_svm_gradient():
    rng = np.random.default_rng(11)
    x, y, theta = rng.normal(size=(9, 3)), rng.integers(0, 3, 9), rng.normal(size=12)
    loss = svm.row_loss(3, 3, 1.0, True)
    assert np.allclose(loss(theta, x, y)[1], numeric_gradient(lambda t: loss(t, x, y)[0], theta), atol=1e-5)


def test_autoencoder_gradient(spark):
    rng = np.random.default_rng(12)
    df = points(spark, rng.uniform(0.1, 0.9, (11, 3)), partitions=2).persist()
    theta = rng.normal(size=3 * 2 * 2 + 5)

    def cost(t):
        return nn.autoencoder_cost(df, nn._unflatten(t, 3, 2), lam=0.01, beta=0.5, rho=0.1)

    grad = cost(theta)[1]
    for i in (0, 5, 7, 9, 13, 16):
        e = np.zeros_like(theta)
        e[i] = 1e-5
        assert np.isclose(grad[i], (cost(theta + e)[0] - cost(theta - e)[0]) / 2e-5, atol=1e-6)
    df.unpersist()


@pytest.mark.parametrize("optimizer", ["lbfgs", "adam", "rmsprop", "sgd"])
def test_classifier_learns_blobs(three, optimizer):
    _, _, df = three
    net = nn.fit_classifier(df, hidden_neurons=8, activation="tanh", optimizer=optimizer, max_iterations=25, step_size=0.05, batch_size=10, seed=2)
    assert tr.accuracy(nn.apply_network(df, net)).first()["accuracy"] > 0.95


def test_classifier_needs_contiguous_labels(three):
    _, _, df = three
    with pytest.raises(ValueError):
        nn.fit_classifier(df.withColumn("label", F.col("label") * 2))
    with pytest.raises(ValueError):
        nn.fit_classifier(df, optimizer="magic")


def test_regressor_with_two_outputs(spark):
    x = np.random.default_rng(13).uniform(-1, 1, (200, 2))
    df = points(spark, x).withColumn("targets", F.array(F.get("features", F.lit(0)) * 2, F.get("features", F.lit(1)) - 1))
    net = nn.fit_regressor(df, "targets", outputs=2, hidden_neurons=4, activation="identity", optimizer="lbfgs", max_iterations=60)
    assert net.loss < 1e-4


@pytest.mark.parametrize("optimizer", ["lbfgs", "psgd"])
def test_svm_learns_blobs(three, optimizer):
    _, _, df = three
    m = svm.fit_svm(df, "label", optimizer=optimizer, max_iterations=40, epochs=40, step_size=0.05)
    assert tr.accuracy(svm.svm_scores(df, m)).first()["accuracy"] > 0.95
    flat = svm.fit_svm(df, "label", no_intercept=True, max_iterations=5)
    assert (flat.intercepts == 0).all()


def test_tree(three):
    _, _, df = three
    out = tr.tree_predict(df, tr.fit_tree(df, minimum_leaf_size=5))
    assert tr.accuracy(out).first()["accuracy"] > 0.98
    assert all(abs(sum(r["probability"]) - 1.0) < 1e-9 for r in out.select("probability").collect())


@pytest.mark.parametrize("kind", ["domingos", "binary"])
@pytest.mark.parametrize("info_gain", [True, False])
def test_hoeffding(three, kind, info_gain):
    _, _, df = three
    # Both features are equally good, so only the sample limit breaks the tie.
    params = tr.HoeffdingParams(numeric_split=kind, info_gain=info_gain, observations_before_binning=30, max_samples=50)
    batch = tr.train_batch(df, tr.new_hoeffding(3, 2, params))
    assert tr.accuracy(tr.hoeffding_predict(df, batch)).first()["accuracy"] > 0.9
    parts = [df.filter(F.col("row_id") % 4 == i) for i in range(4)]
    stream = tr.train_incremental(parts, tr.new_hoeffding(3, 2, params), passes=3)
    assert tr.accuracy(tr.hoeffding_predict(df, stream)).first()["accuracy"] > 0.85


@pytest.mark.parametrize("rule", ["sgd", "psgd", "rmsprop", "adam"])
def test_global_batches_do_not_depend_on_partitions(spark, rule):
    rng = np.random.default_rng(16)
    x, y = blobs(rng, 40)
    lam = 1e-3

    def penalty(t):
        return 0.5 * lam * float(t @ t), lam * t

    loss = svm.row_loss(3, 2, 1.0, True)
    got = []
    for partitions in (2, 8):
        df = points(spark, x, partitions, label=y)
        got.append(tn.global_passes(df, ["features", "label"], np.zeros(9), loss, penalty, optimizer=rule, step_size=0.02, batches=4, epochs=3, tolerance=0.0, batch_of=F.col("row_id") % 4))
    assert np.allclose(got[0][0], got[1][0], rtol=1e-9, atol=1e-12) and np.isclose(got[0][1], got[1][1])
    step, theta = tn.Stepper(rule, 0.02, 9), np.zeros(9)
    for _ in range(3):
        for b in range(4):
            mine = np.arange(len(x)) % 4 == b
            theta = step(theta, loss(theta, x[mine], y[mine])[1] / mine.sum() + penalty(theta)[1])
    assert np.allclose(got[0][0], theta)


def test_fits_by_global_batches(spark, three):
    x, y, df = three
    with_class = df.withColumn("class", F.col("label"))
    a, b = (svm.fit_svm(with_class.repartition(k), optimizer="psgd", epochs=6, step_size=0.05, batches=3) for k in (2, 7))
    assert np.allclose(a.weights, b.weights) and np.allclose(a.intercepts, b.intercepts)
    assert (np.argmax(x @ a.weights.T + a.intercepts, 1) == y).mean() > 0.95
    nets = [nn.fit_classifier(df.repartition(k), hidden_neurons=4, activation="tanh", optimizer="adam", step_size=0.05, max_iterations=4, batches=3) for k in (2, 7)]
    assert np.allclose(nets[0].theta, nets[1].theta, atol=1e-8)
    with pytest.raises(ValueError):
        tn.global_passes(df.limit(0), ["features", "label"], np.zeros(9), svm.row_loss(3, 2, 1.0, True), tn.no_penalty, optimizer="sgd", step_size=0.1, batches=2, epochs=1, tolerance=0.0)


def test_exact_splits_of_batches(spark, tmp_path):
    """The value table adds up over batches and survives writing; the split is the best of all values."""
    rng = np.random.default_rng(15)
    x = np.round(rng.normal(size=(240, 2)), 1)
    y = (x[:, 1] > 0.3).astype(int) + 0
    y[:9] = 1 - y[:9]
    df = points(spark, x, label=y)
    params = tr.HoeffdingParams(numeric_split="binary", min_samples=240, max_samples=1)
    tree = tr.new_hoeffding(2, 2, params)
    for k in range(3):
        tree = tr.observe(df.filter(F.col("row_id") % 3 == k), tree)
        tree, made = tr.grow(tree)
        assert made == (k == 2)
        if not made:
            for ext in ("", ".json"):
                save_model(spark, tree, str(tmp_path / f"t{k}{ext}"))
                tree = load_model(spark, str(tmp_path / f"t{k}{ext}"))

    def gini(v):
        p = np.bincount(v, minlength=2) / max(len(v), 1)
        return 1 - (p * p).sum()

    best = max((round(gini(y) - (s := x[:, f] <= v).mean() * gini(y[s]) - (~s).mean() * gini(y[~s]), 9), -f, -v) for f in (0, 1) for v in np.unique(x[:, f])[:-1])
    root = tree.nodes[0]
    assert (root.feature, root.thresholds) == (-best[1], (float(np.nextafter(-best[2], np.inf)),))
    left = x[:, root.feature] < root.thresholds[0]
    assert [tree.nodes[c].counts for c in root.children] == [tuple(np.bincount(y[m], minlength=2).astype(float)) for m in (left, ~left)]
    assert tree.values.count() == 0
    again = tr.observe(df, tree)
    assert {leaf: tuple(n) for leaf, n in tr.leaf_sizes(again).items()} == {c: tree.nodes[c].counts for c in root.children}


def test_hoeffding_waits_for_ranges(spark, three):
    _, _, df = three
    params = tr.HoeffdingParams(observations_before_binning=100)
    small = df.filter("row_id < 20")
    tree = tr.observe(small, tr.new_hoeffding(3, 2, params))
    assert len(tree.waiting) == 20 and not tree.histograms
    tree = tr.observe(df.filter("row_id >= 20"), tree)
    assert not tree.waiting and tree.histograms[0][0].sum() == 180


def test_split_gains_match_direct_counts(spark):
    rng = np.random.default_rng(14)
    x, y = np.round(rng.normal(size=(90, 2)), 1), rng.integers(0, 3, 90)
    df = points(spark, x, label=y)

    def gini(v):
        p = np.bincount(v, minlength=3) / max(len(v), 1)
        return 1 - (p * p).sum()

    for r in tr.split_gains(df, 3).collect():
        left = x[:, r["feature_idx"]] <= r["value"]
        want = gini(y) - left.mean() * gini(y[left]) - (1 - left.mean()) * gini(y[~left])
        assert r["n_left"] == left.sum() and np.isclose(r["gain"], want)


def test_models_survive_writing(spark, three, tmp_path):
    _, _, df = three
    scaler = scaling.fit_scaler(df, "pca_whitening")
    tree = tr.train_batch(df, tr.new_hoeffding(3, 2))
    mix = gm.fit_mixture(df, 2, max_iterations=2)
    for i, model in enumerate((scaler, tree, mix, scaling.Autoscaled(scaler, mix), som.Map(1, 2, np.eye(2)))):
        for ext in ("", ".json", ".xml"):
            path = str(tmp_path / f"m{i}{ext}")
            save_model(spark, model, path)
            back = load_model(spark, path)
            assert type(back) is type(model)
    assert np.array_equal(load_model(spark, str(tmp_path / "m0")).matrix, scaler.matrix)
    again = load_model(spark, str(tmp_path / "m1.json"))
    assert again.nodes == tree.nodes and all(np.array_equal(again.histograms[k], v) for k, v in tree.histograms.items())
    with pytest.raises(ValueError):
        save_model(spark, None, str(tmp_path / "none"))


def test_exact_tree_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = ((x[:, 0] > 0.2).astype(int) + (x[:, 1] > -0.3)) * (rng.random(300) > 0.1)
    tree, made = tr.train_exact(points(spark, x, label=y), 3, 3, minimum_leaf_size=5, minimum_gain_split=0.01)

    def gini(v):
        p = np.bincount(v, minlength=3) / len(v)
        return 1 - (p * p).sum()

    def grow(rows, out):
        best = None
        for f in range(3):
            for v in np.unique(x[rows, f]):
                low = rows[x[rows, f] <= v]
                high = rows[x[rows, f] > v]
                if min(len(low), len(high)) >= 5:
                    g = round(gini(y[rows]) - len(low) / len(rows) * gini(y[low]) - len(high) / len(rows) * gini(y[high]), 9)
                    if best is None or g > best[0]:
                        best = (g, f, v, low, high)
        if best and best[0] > 0.01:
            out.append((best[1], float(best[2]), len(rows)))
            grow(best[3], out)
            grow(best[4], out)
        return out

    assert sorted((s.feature, s.value, s.n) for s in made) == sorted(grow(np.arange(300), []))
    assert max(s.level for s in made) > 2
    with pytest.raises(ValueError):
        tr.train_exact(points(spark, x, label=y + 1), 3, 3)
