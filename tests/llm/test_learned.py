"""Toxicity and language against labels they have not seen; packing and vectors against brute force."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from vectable.llm import language, packing, polytope, queries, toxicity
from vectable.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
with_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@with_tables
def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark, corpus, clashing, no_rows):
    model = language.fit(corpus, "text", "lang", F.lit(True))
    assert model.languages == ["de", "en"]
    got = language.identify(clashing, model)
    assert got.columns == [*[c for c in clashing.columns if c != "score"], "lang_pred", "score", "ambiguous"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
    assert language.identify(no_rows, model).count() == 0
    nothing = language.fit(no_rows, "text", "lang", F.lit(True))
    assert {r.lang_pred for r in language.identify(corpus, nothing).collect()} == {"und"}
    one = language.fit(corpus.where("lang = 'de'"), "text", "lang", F.lit(True))
    assert {r.lang_pred for r in language.identify(corpus, one).collect()} == {"de", "und"}


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 20])
def test_codewords_are_apart(n):
    codes = language.codewords(n)
    assert all((codes[i] != codes[j]).sum() >= max(1, codes.shape[1] // 4) for i in range(n) for j in range(i))
    assert (np.abs(codes.sum(0)) < n).all()


@with_tables
def test_toxicity_of_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if not y], [s for s, y in held if y]
    assert np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good]) > 0.85


def test_toxicity_learns_from_allowed_rows_alone(spark):
    """Flipped labels of rows outside the condition change no score."""
    rng = random.Random(4)
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        text = prose(rng, 30) + (" you " + rng.choice(["grumpf", "zonk"]) + " now" if bad else "")
        docs.append((k, text))
        labels.append((k, int(bad)))
    d = spark.createDataFrame(docs + [(None, "you zonk"), (900, None), (901, ""), (902, "you zonk you grumpf"), (902, "you zonk you grumpf")], "doc_id bigint, text string").withColumn("score", F.lit(1)).withColumn("features", F.lit(1)).repartition(4)
    learn = lambda i: F.crc32(i.cast("string")) % 5 != 0
    kind = "doc_id bigint, toxic int"
    y = spark.createDataFrame(labels, kind)
    flipped = y.withColumn("toxic", F.when(learn(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = ({(r.doc_id, r.score) for r in toxicity.score(d, toxicity.fit(d, t, learn)).collect()} for t in (y, flipped))
    assert a == b
    scores = dict(a)
    assert scores[902] > 0.5 > scores[901]
    assert scores[900] == scores[901]
    for only in (y.where("toxic = 0"), y.limit(0)):
        flat = toxicity.score(d, toxicity.fit(d, only, learn)).collect()
        assert {r.score for r in flat} == {0.0} and len(flat) == d.count()
    assert toxicity.score(d.limit(0), toxicity.fit(d, y, learn)).count() == 0


def test_packing_is_whole(clashing, no_rows):
    got = packing.pack(clashing, capacities=(16, 32, 64), shard_docs=20).collect()
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append((r.piece_start, r.n_tokens))
    want = defaultdict(list)
    for r in clashing.collect():
        n = len((r.text or "").encode().split())
        want[r.doc_id] += [(k * 64, min(64, n - k * 64)) for k in range(max(1, -(-n // 64)))]
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in want.items()}
    bins = defaultdict(list)
    for r in got:
        assert (r.bin_id is None) == (r.n_tokens == 0)
        if r.n_tokens:
            bins[r.bin_id].append((r.bin_offset, r.n_tokens, r.capacity))
    for pieces in bins.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [sum(p[1] for p in pieces[:k]) for k in range(len(pieces))]
        total = sum(p[1] for p in pieces)
        assert {p[2] for p in pieces} == {min(c for c in (16, 32, 64) if c >= total)}
    assert packing.pack(no_rows).count() == 0


def plain_best_fit(lengths, caps):
    waiting, room, where = Counter(), [], []
    for n in lengths:
        waiting[n] += n
    for n in lengths:
        waiting[n] -= n
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if not fits:
            c = min((c for c in caps if c >= n), key=lambda c: (packing.cost(c) / (n + min(c - n, sum(v for m, v in waiting.items() if m <= c - n))), c))
            room.append(c)
            fits = [(c, len(room) - 1)]
        least = min(r for r, _ in fits)
        where.append(least)
        room[max(k for r, k in fits if r == least)] -= n
    return sorted(room), where


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(2)
    for caps in ((512, 1024, 2048, 4096), (64,), (10, 1000)):
        lengths = np.sort(np.minimum(rng.geometric(0.01, 400), max(caps)))[::-1]
        bins, offsets, size = packing.best_fit(lengths, caps)
        left, used = plain_best_fit(lengths.tolist(), caps)[0], np.bincount(bins, lengths)
        assert len(left) == len(size) and (used <= size).all()
        assert all(s == min(c for c in caps if c >= u) for s, u in zip(size, used))


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(160):
        v = rng.normal(size=24)
        rows.append([v.tolist(), k % 3])
        for _ in range(k % 4):
            rows.append([(v + rng.normal(size=24) * 0.3 * rng.random()).tolist(), k % 3])
    ball = rng.normal(size=24)
    rows += [[(ball + rng.normal(size=24) * 0.15).tolist(), 1] for _ in range(150)]
    rows += [[rows[0][0], 0] for _ in range(60)] + [[rows[0][0], 1], [[2 * x for x in rows[0][0]], 0]]
    rows += [[None, 0], [[0.0] * 24, 0], [[float("nan")] * 24, 0], [[float("inf"), *[1.0] * 23], 0], [[None, *[1.0] * 23], 0], [[], 0], [rows[0][0], None], [[1.0, 2.0], 0], [[1.0, 2.1], 0], [[1e300, 1e300], 0], [[1e-300, 1e-300], 0]]
    return [(k, v, y) for k, (v, y) in enumerate(rows)] + [(None, rows[0][0], 0), (5, rows[5][0], rows[5][1])]


def test_vector_links(spark, monkeypatch):
    monkeypatch.setattr(polytope, "BLOCK_ROWS", 32)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("good", F.lit(0)).repartition(4)
    usable = [k for k, (_, v, y) in enumerate(rows) if y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: polytope.unit_rows([rows[k][1]])[0] for k in usable}
    links, root = Counter(), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93:
                links[a] += 1
                links[b] += 1
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = defaultdict(lambda: None)
    for k, (i, _, _) in enumerate(rows):
        if i is not None and (least[top(k)] is None or i < least[top(k)]):
            least[top(k)] = i
    want = Counter((i, links[k], least[top(k)], i is not None and i == least[top(k)]) for k, (i, _, _) in enumerate(rows))
    got = Counter(tuple(r) for r in polytope.near_duplicates(df, tables=12).collect())
    assert got == want
    usual = sum(r.n_links for r in polytope.near_duplicates(df).collect())
    assert 0.97 * sum(links.values()) <= usual <= sum(links.values())
    assert polytope.near_duplicates(df.limit(0)).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 32))
    y = polytope.rotated(x, polytope.rotation_signs(32, 1, 1, 3)[0, 0])
    assert np.allclose((x * x).sum(1), (y * y).sum(1))
    h = polytope.hadamard(np.eye(32))
    assert np.allclose(h @ h.T, np.eye(32)) and np.allclose(np.abs(h), 32**-0.5)


def test_one_query_for_each_operator():
    assert [sum(q.startswith(f"op{n}_") for q in queries.QUERIES) for n in range(1, 11)] == [1] * 10
