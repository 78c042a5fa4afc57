"""What the learned operators learn from, and their arithmetic, against plain Python."""

import math
import random

import numpy as np
from llm_texts import prose
from pyspark.sql import functions as F

from vectable.llm import language, toxicity


def test_language_sample_is_bounded(spark, monkeypatch):
    """Copies count once; neither rows nor bytes pass their bounds; a language of long texts alone still teaches one."""
    rng = random.Random(1)
    rows = [("en", "the very same text")] * 400 + [("en", prose(rng, 20)) for _ in range(100)]
    rows += [("de", "wörter " + prose(rng, 20)) for _ in range(50)] + [("fr", "é " + prose(rng, 3000)) for _ in range(3)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    seen = []
    monkeypatch.setattr(language, "train_bits", lambda x, y, codes, **k: seen.append((x, y)) or (np.zeros((x.shape[1], codes.shape[1])), np.zeros(codes.shape[1])))
    sizes = []
    monkeypatch.setattr(language, "gram_counts", lambda texts, count=language.gram_counts: sizes.append([len(t) for t in texts]) or count(texts))
    for options, most in (({"per_language": 30}, 30), ({"sample_rows": 12}, 4), ({"sample_bytes": 6000}, 30)):
        language.fit(df, "text", "lang", F.lit(True), **options)
        x, y = seen.pop()
        counts = np.bincount(y, minlength=3)
        assert (counts >= 1).all() and counts.max() <= most
        assert len(np.unique(x, axis=0)) == len(x)
        if "sample_bytes" in options:
            by_language = [sum(n - 2 for n, k in zip(sizes[-1], y) if k == j) for j in range(2)]
            assert max(by_language) <= 2000


def test_gram_counts():
    texts = ["", "a", "Ab äß 9 Ab", "zz " * 50, None]
    got = language.gram_counts([language.letters_only(t) for t in texts])
    for row, t in zip(got, texts):
        b = language.letters_only(t)
        want = np.zeros(language.BUCKETS)
        for n in language.GRAMS:
            for k in range(len(b) - n + 1):
                h = n
                for c in b[k : k + n]:
                    h = ((h * 0x01000193) & 0xFFFFFFFF) ^ c
                want[((h * 0x9E3779B1) & 0xFFFFFFFF) >> 20] += 1
        want = np.log1p(want)
        want /= max(math.sqrt((want * want).sum()), 1e-12)
        assert np.allclose(row, want, atol=1e-6)
    assert language.letters_only("Ab, äß 9 AB!") == " ab äß ab ".encode()


def test_decoding():
    rng = np.random.default_rng(2)
    model = language.Model(["a", "b", "c"], language.codewords(3), np.zeros((1, 1)), np.zeros(1))
    margins = rng.normal(size=(40, model.codes.shape[1])) * 3
    margins[0] = 0.0
    best, score, doubt = language.decode(model, margins)
    for m, b, s, d in zip(margins, best, score, doubt):
        losses = [sum((abs(math.tanh(x / 2)) + 1e-3) * math.log1p(math.exp(-x * c)) for x, c in zip(m, code)) for code in model.codes]
        weights = [math.exp(min(losses) - v) for v in losses]
        first, second = sorted(losses)[:2]
        assert losses[b] <= first + 1e-9 and abs(s - 1 / sum(weights)) < 1e-9
        assert d == (second - first <= language.AMBIGUITY * second)
    assert doubt[0] and not doubt.all()


def test_an_id_of_many_rows_teaches_once(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, f"row {k:04d}") for k in range(500)] + [(i, prose(rng, 9)) for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id bigint, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda sample: seen.append(sorted(r.text for r in sample.collect())) or 1 / 0)
    try:
        toxicity.fit(docs, labels, lambda doc_id: F.lit(True))
    except ZeroDivisionError:
        pass
    assert seen == [sorted(["row 0000"] + [t for _, t in rows[500:]])]
