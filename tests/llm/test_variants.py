"""Words one edit apart, their forms and roots, against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vectable.llm import variants


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(vocab):
    words = sorted(vocab)
    out = {}
    for w in words:
        beside = [x for x in words if near(w, x)]
        best = min(beside, key=lambda x: (-vocab[x], x), default=None)
        form = best if best and vocab[best] >= 2 * vocab[w] else None
        out[w] = [form, None, vocab[w], len(beside), vocab[form] if form else None]
    for w in words:
        end = w
        while out[end][0]:
            end = out[end][0]
        out[w][1] = end
    return {(w, *v) for w, v in out.items()}


def check(spark, vocab):
    df = spark.createDataFrame(list(vocab.items()), "word string, n bigint").repartition(4)
    got = variants.variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(vocab)
    assert set(rows) == brute(vocab)


def some_words(seed, letters, lo, hi, n):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = [rng.choice(letters) for _ in range(rng.randint(lo, hi))]
        words.add("".join(w))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w))
            rng.choice([lambda: w.pop(k) if len(w) > 1 else None, lambda: w.insert(k, rng.choice(letters)), lambda: w.__setitem__(k, rng.choice(letters))])()
            words.add("".join(w))
    return {w: rng.choice([1, 2, 3, 4, 8, 16, 40, 200]) for w in words}


@pytest.mark.parametrize("letters, lo, hi, n", [("ab", 1, 7, 120), ("abcdé", 5, 9, 300), ("aÀÿz", 3, 12, 200)])
def test_matches_all_pairs(spark, letters, lo, hi, n):
    check(spark, some_words(n, letters, lo, hi, n))


def test_words_longer_than_the_trie(spark):
    vocab = some_words(7, "abé", 28, 36, 150) | {"a" * k: k for k in range(29, 38)}
    check(spark, vocab)
    long = "ab" * 20_000
    check(spark, {long: 5, long + "a": 50, long[1:]: 3, long[:777] + "c" + long[778:]: 4, long[:777] + "d" + long[778:]: 4, "other": 3})


def test_chains_and_ties(spark):
    """A chain of forms of seven steps, and near words of equal n."""
    chain = {"a" * (5 + k): 3 * 2**k for k in range(8)}
    check(spark, chain | {"bbbbb": 3, "bbbbc": 8, "bbbbd": 8, "zzzzz": 5})
    check(spark, {"alone": 3})
    check(spark, {"ab": 3, "a": 3, "b": 6})


def test_no_words(spark, no_rows):
    df = spark.createDataFrame([], "word string, n bigint")
    assert variants.variants(df).count() == 0
    assert variants.variants(variants.vocabulary(variants.runs(no_rows).select(F.col("run").alias("word")))).count() == 0
    with pytest.raises(ValueError):
        variants.variants(df, least_ratio=1)


def test_runs_and_counts(spark, corpus, clashing):
    texts = [r.text or "" for r in corpus.select("text").collect()]
    plain = {}
    for text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            plain[w] = plain.get(w, 0) + 1
    expected = {(w, n) for w, n in plain.items() if len(w) >= 5 and n >= 3}
    for df in (corpus, clashing):
        got = variants.vocabulary(variants.runs(df).select(F.col("run").alias("word")))
        assert set(map(tuple, got.collect())) == expected
    word = spark.createDataFrame([("añb", 1)], "w string, at int").select(variants.without(F.col("w"), F.col("at")).alias("x"))
    assert word.first().x == "ab"
