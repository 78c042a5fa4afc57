"""Rows ahead, frames and spacings against plain loops, for groups that span partitions and for many small ones."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vectable.operators import halo, markov, spectra
from vectable.operators.independent import TINY, spacing_entropy
from vectable.operators.order import whole_groups


def grouped(rng, n):
    """A group with a third of the rows, many small ones, NULL, and one row alone."""
    names = ["big"] * (n // 3) + [None] * (n // 6) + [f"g{k // 3}" for k in range(n // 2)] + ["alone"]
    return [(g, int(v), float(x)) for g, v, x in zip(names, rng.integers(0, n // 4, len(names)), rng.normal(size=len(names)))]


def plain(rows, reach):
    out = Counter()
    for g in {r[0] for r in rows}:
        mine = sorted((r[1], r[2]) for r in rows if r[0] == g)
        m = reach(len(mine))
        out.update((g, len(mine), *mine[i], *mine[i + m]) for i in range(len(mine) - m))
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
@pytest.mark.parametrize("reach, plainly", [(halo.one_ahead, lambda n: 1), (halo.root_ahead, lambda n: int(n**0.5)), (lambda n: n * 0 + 50, lambda n: 50)])
def test_rows_ahead(spark, partitions, reach, plainly):
    rows = grouped(np.random.default_rng(int(partitions)), 360)
    df = spark.createDataFrame(rows, "g string, v bigint, x double").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = halo.rows_ahead(df, ["g"], ["v", "x"], ["v", "x"], reach).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert Counter(map(tuple, got)) == plain(rows, plainly)


def test_nothing_ahead(spark):
    df = spark.createDataFrame([], "g string, v bigint")
    assert halo.rows_ahead(df, ["g"], ["v"], ["v"]).columns == ["g", "n", "v", "v_ahead"]
    assert halo.rows_ahead(df, ["g"], ["v"], ["v"]).count() == 0
    one = spark.createDataFrame([("a", 1), (None, 2)], "g string, v bigint")
    assert halo.rows_ahead(one, ["g"], ["v"], ["v"]).count() == 0


def test_roots():
    n = np.array([1, 2, 3, 4, 8, 9, 10**12 - 1, 10**12, (2**31) ** 2, (2**31) ** 2 - 1])
    assert halo.root_ahead(n).tolist() == [1, 1, 1, 2, 2, 3, 10**6 - 1, 10**6, 2**31, 2**31 - 1]


def test_spacings_with_ties(spark):
    rng = np.random.default_rng(4)
    rows = [("a", i, float(v)) for i, v in enumerate(np.round(rng.normal(size=200), 1))] + [("b", i, 1.0) for i in range(30)] + [("c", 0, 5.0)]
    got = {r.g: (r.n, r.entropy) for r in spacing_entropy(spark.createDataFrame(rows, "g string, i int, z double"), "z", ["i"], "g").collect()}
    for g in "ab":
        z = np.sort([r[2] for r in rows if r[0] == g])
        m = int(np.sqrt(len(z)))
        assert got[g][0] == len(z) and np.isclose(got[g][1], np.log(np.maximum(z[m:] - z[:-m], TINY)).sum())
    assert "c" not in got


def test_transitions(spark):
    rng = np.random.default_rng(5)
    rows = [(s, t, int(rng.integers(0, 3))) for s, n in (("x", 400), ("y", 1), (None, 20)) for t in rng.permutation(n).tolist()]
    want = Counter()
    for s in ("x", "y", None):
        states = [r[2] for r in sorted((r for r in rows if r[0] == s), key=lambda r: r[1])]
        want.update(zip(states, states[1:]))
    got = markov.transition_counts(spark.createDataFrame(rows, "seq string, t bigint, state int").repartition(5)).collect()
    assert {(r.state, r.next_state): r.n for r in got} == dict(want)


@pytest.mark.parametrize("fftsize, overlap", [(16, 1), (32, 4), (64, 2)])
def test_frames_over_blocks(spark, monkeypatch, fftsize, overlap):
    """Series longer and shorter than a block, and one with samples missing."""
    monkeypatch.setattr(spectra, "BLOCK_SAMPLES", 128)
    rng = np.random.default_rng(6)
    series = {"long": rng.normal(size=1003), "one": rng.normal(size=1), None: rng.normal(size=130)} | {f"s{k}": rng.normal(size=k) for k in range(2, 40, 7)}
    rows = [(s, i, float(v)) for s, x in series.items() for i, v in enumerate(x) if not (s is None and 40 <= i < 60)]
    got = spectra.frames(spark.createDataFrame(rows, "series string, n bigint, sample double").repartition(6), fftsize, overlap).collect()
    hop = fftsize // overlap
    want = {}
    for s, x in series.items():
        x = np.where((np.arange(len(x)) >= 40) & (np.arange(len(x)) < 60), 0.0, x) if s is None else x
        for f in range((len(x) - 1) // hop + 1):
            cut = x[f * hop : f * hop + fftsize]
            want[s, f] = [*cut, *[0.0] * (fftsize - len(cut))]
    assert {(r.series, r.frame): r.samples for r in got} == want and len(got) == len(want)


def test_groups_are_never_parted():
    keys = [0, 0, 1, 2, 2, 2, 2, 3, 4, 4]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:b]), pa.array(range(a, b))], ["k", "v"]) for a, b in ((0, 1), (1, 4), (4, 4), (4, 6), (6, 10))]
    for least in (1, 3, 100):
        seen = []
        for table, at in whole_groups(iter(batches), 1, least):
            k = table["k"].to_pylist()
            assert at[0] == 0 and at[-1] == len(k) and all(len(set(k[a:b])) == 1 for a, b in zip(at, at[1:])) and len(set(k)) == len(at) - 1
            seen += k
        assert seen == keys
    assert list(whole_groups(iter([]), 1, 5)) == []
