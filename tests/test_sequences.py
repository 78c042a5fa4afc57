"""Markov models and spectra against direct recursions, in one piece and in chunks."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.operators import markov as mk, scan, spectra as sp

RNG = np.random.default_rng(0)
MODEL = mk.Hmm(
    "discrete", np.array([0.6, 0.3, 0.1]), np.array([[0.7, 0.2, 0.1], [0.25, 0.5, 0.25], [0.05, 0.35, 0.6]]),
    tables=(np.array([[0.5, 0.3, 0.2], [0.1, 0.6, 0.3], [0.25, 0.15, 0.6]]),),
)


@pytest.fixture(scope="module")
def sequences(spark):
    """One long sequence with most rows, and short ones down to a single row."""
    lengths = {1: 40, 2: 7, 3: 1, 4: 12}
    rows = [(s, t, [float(RNG.integers(0, 3))]) for s, n in lengths.items() for t in range(n)]
    df = spark.createDataFrame(rows, "seq bigint, t bigint, features array<double>").repartition(5).persist()
    data = {s: np.array([r[2][0] for r in rows if r[0] == s], dtype=int) for s in lengths}
    yield df, data
    df.unpersist()


def forward(o, m=MODEL):
    a = m.start * m.tables[0][:, o[0]]
    for v in o[1:]:
        a = (a @ m.trans) * m.tables[0][:, v]
    return np.log(a.sum())


@pytest.mark.parametrize("chunk_rows", [3, 5, 4096])
def test_log_likelihood(sequences, chunk_rows):
    df, data = sequences
    got = {r["seq"]: (r["n"], r["loglik"]) for r in mk.log_likelihood(df, MODEL, chunk_rows=chunk_rows).collect()}
    assert {s: n for s, (n, _) in got.items()} == {s: len(o) for s, o in data.items()}
    assert all(np.isclose(got[s][1], forward(o)) for s, o in data.items())


@pytest.mark.parametrize("chunk_rows", [3, 5, 4096])
def test_viterbi(sequences, chunk_rows):
    df, data = sequences
    paths = {}
    for r in mk.viterbi(df, MODEL, chunk_rows=chunk_rows).orderBy("seq", "pos").collect():
        assert r["pos"] == len(paths.setdefault(r["seq"], []))
        paths[r["seq"]].append(r["state"])

    def score(path, o):
        p = np.log(MODEL.start[path[0]]) + np.log(MODEL.tables[0][path[0], o[0]])
        return p + sum(np.log(MODEL.trans[a, b]) + np.log(MODEL.tables[0][b, v]) for a, b, v in zip(path, path[1:], o[1:]))

    for s, o in data.items():
        delta = np.log(MODEL.start) + np.log(MODEL.tables[0][:, o[0]])
        for v in o[1:]:
            delta = (delta[:, None] + np.log(MODEL.trans)).max(0) + np.log(MODEL.tables[0][:, v])
        assert len(paths[s]) == len(o) and np.isclose(score(paths[s], o), delta.max())


def test_training_does_not_depend_on_chunks(sequences):
    df, data = sequences
    fits = [mk.fit_hmm(df, 3, kind="discrete", max_iterations=4, chunk_rows=c, start=MODEL) for c in (3, 7, 4096)]
    for f in fits[1:]:
        assert np.allclose(f.trans, fits[0].trans) and np.allclose(f.tables[0], fits[0].tables[0]) and np.isclose(f.loglik, fits[0].loglik)
    first = mk.fit_hmm(df, 3, kind="discrete", max_iterations=1, start=MODEL)
    assert np.isclose(first.loglik, sum(forward(o) for o in data.values()))
    assert fits[0].loglik > first.loglik


def test_expected_counts_by_enumeration(spark):
    o = [0, 2, 1]
    df = spark.createDataFrame([(0, t, [float(v)]) for t, v in enumerate(o)], "seq bigint, t bigint, features array<double>")
    pairs, start, total = np.zeros((3, 3)), np.zeros(3), 0.0
    for path in itertools.product(range(3), repeat=3):
        p = MODEL.start[path[0]] * np.prod([MODEL.tables[0][s, v] for s, v in zip(path, o)]) * MODEL.trans[path[0], path[1]] * MODEL.trans[path[1], path[2]]
        total += p
        start[path[0]] += p
        pairs[path[0], path[1]] += p
        pairs[path[1], path[2]] += p
    for chunk_rows in (1, 2, 10):
        chunks = mk.chunked(df, chunk_rows=chunk_rows)
        got = mk._expectation(chunks, MODEL, mk._is_long(chunks))
        assert np.allclose(got["start"], start / total) and np.allclose(got["pairs"], pairs / total)
        assert np.isclose(got["ll"].item(), np.log(total))


def test_gaussian_training_raises_likelihood(spark):
    rng = np.random.default_rng(2)
    rows, s = [], 0
    for t in range(300):
        s = s if rng.random() < 0.9 else 1 - s
        rows.append((0, t, [float(rng.normal(4 * s, 0.5)), float(rng.normal(-2 * s, 0.5))]))
    df = spark.createDataFrame(rows, "seq bigint, t bigint, features array<double>")
    m = mk.fit_hmm(df, 2, max_iterations=25, chunk_rows=64)
    logs = [mk.fit_hmm(df, 2, max_iterations=i).loglik for i in (1, 3)]
    assert logs[0] < logs[1] <= m.loglik + 1e-6
    assert np.allclose(np.sort(m.means[:, 0]), [0.0, 4.0], atol=0.3)


@pytest.mark.parametrize("fan_in", [2, 3, 100])
@pytest.mark.parametrize("best", [True, False])
def test_prefix_products(spark, fan_in, best):
    rng = np.random.default_rng(3)
    lengths = {7: 13, 8: 1, 9: 5}
    mats = {s: rng.normal(size=(n, 2, 2)) for s, n in lengths.items()}
    rows = [(s, c, [float(v) for v in m.reshape(-1)]) for s, ms in mats.items() for c, m in enumerate(ms)]
    df = spark.createDataFrame(rows, "seq bigint, c bigint, m array<double>").repartition(4)
    start = np.array([0.1, -0.4])
    got = {(r["seq"], r["c"]): r["entry"] for r in scan.entering(df, start, best=best, fan_in=fan_in).collect()}
    assert len(got) == len(rows)
    for s, ms in mats.items():
        v = start
        for c, m in enumerate(ms):
            assert np.allclose(got[s, c], v)
            v = scan.log_times(v, m, best)


def test_labelled_training(spark):
    rng = np.random.default_rng(4)
    rows = [(q, t, [float(rng.normal(5 * (t % 2), 1.0)), float(rng.normal())], t % 2, q * 100 + t) for q in range(4) for t in range(30)]
    df = spark.createDataFrame(rows, "seq bigint, t bigint, features array<double>, state int, id bigint")
    m = mk.fit_hmm_labelled(df, 2, kind="gaussian")
    assert np.allclose(m.trans, [[0, 1], [1, 0]]) and np.allclose(m.start, [1, 0]) and np.allclose(m.means[:, 0], [0, 5], atol=0.5)
    for kind in ("gmm", "diag_gmm"):
        g = mk.fit_hmm_labelled(df, 2, kind=kind, gaussians=2, id_col="id", max_iterations=3)
        states = np.array([r["state"] for r in mk.viterbi(df, g).orderBy("seq", "pos").collect()])
        assert (states == np.array([r[3] for r in rows])).all()
        assert mk.generate(spark, g, 5, 3).count() == 15
        with pytest.raises(ValueError):
            mk.fit_hmm(df, 2, kind=kind)
    with pytest.raises(ValueError):
        mk.fit_hmm_labelled(df, 1)


def test_generation_follows_the_model(spark):
    g = mk.generate(spark, MODEL, 60, 200, seed=5)
    again = mk.generate(spark, MODEL, 60, 200, seed=5)
    assert g.exceptAll(again).count() == 0
    n = mk.transition_counts(g)
    counts = np.zeros((3, 3))
    for r in n.collect():
        counts[r["state"], r["next_state"]] = r["n"]
    assert counts.sum() == 200 * 59
    assert np.abs(counts / counts.sum(1, keepdims=True) - MODEL.trans).max() < 0.04
    first = mk.generate_states(spark, MODEL, 3, 20, start_state=9).filter("t = 0").select("state").distinct().collect()
    assert [r["state"] for r in first] == [2]


def wave(spark, n, f):
    return spark.range(n).select(F.lit(1).alias("series"), F.col("id").alias("n"), f(F.col("id")).alias("sample"))


def test_sine_peaks_in_its_bin(spark):
    df = wave(spark, 512, lambda n: F.cos(n * (2 * np.pi * 5 / 64)))
    z = sp.stft(df, fftsize=64, overlap=4, output_polar=True).filter("frame = 8")
    top = z.orderBy(F.col("mag").desc()).first()
    assert top["bin"] == 5 and z.count() == 32


@pytest.mark.parametrize("polar", [True, False])
@pytest.mark.parametrize("full", [True, False])
def test_spectrum_round_trip(spark, polar, full):
    df = wave(spark, 400, lambda n: F.cos(n * 0.2) + F.sin(n * 0.05))
    z = sp.stft(df, fftsize=64, overlap=4, full_spectrum=full, output_polar=polar)
    back = sp.istft(z, fftsize=64, overlap=4, input_polar=polar).withColumnRenamed("sample", "b")
    worst = df.join(back, ["series", "n"]).filter("n >= 48 and n < 336").agg(F.max(F.abs(F.col("sample") - F.col("b")))).first()[0]
    assert worst < 1e-3


def test_spectrum_parameters(spark):
    df = wave(spark, 20, lambda n: n * 1.0)
    for bad in ({"fftsize": 8}, {"fftsize": 48}, {"overlap": 3}, {"window": "kaiser"}):
        with pytest.raises(ValueError):
            sp.stft(df, **bad)
    assert sp.frames(df, 16, 4).count() == 5
