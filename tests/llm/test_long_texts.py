"""Texts with very many hits: the work grows with the text, and the results are those of plain Python."""

import random
import time
from collections import Counter

import pytest
from llm_texts import prose
from pyspark.sql import functions as F
from test_pipeline import masked
from test_scans import added_spans, base_spans

from vectable.llm import licences, secrets


def brute_lines(lines, t):
    """Every run of lines that begins with a known bigram in its first line; of equally good ones the first and shortest."""
    best = {}
    for i in range(len(lines)):
        w = []
        if licences.bigrams(lines[i][1] + [x for _, more in lines[i + 1 : i + 2] for x in more[:1]]).isdisjoint(t.holders):
            continue
        for last, more in lines[i:]:
            w = w + more
            pairs = licences.bigrams(w)
            for licence, name, b in t.entries:
                dice = 2 * len(pairs & b) / (len(pairs) + len(b))
                if dice >= t.threshold and (licence not in best or dice > best[licence][1]):
                    best[licence] = (name, dice, lines[i][0], last - lines[i][0] + 1)
    return best


def brute_words(w, t):
    """The best window from every word for every template; then those that share most, without overlaps."""
    windows = []
    for licence, name, b in t.entries:
        for i in range(len(w) - 1):
            best = None
            for end in range(i + 2, len(w) + 1):
                pairs = licences.bigrams(w[i:end])
                dice = 2 * len(pairs & b) / (len(pairs) + len(b))
                if (w[i], w[i + 1]) in b and dice >= t.threshold and (best is None or dice > best[0]):
                    best = (dice, len(pairs & b), end)
            if best:
                windows.append((-best[1], -best[0], i, best[2], licence, name))
    taken = []
    for _, dice, i, end, licence, name in sorted(windows):
        if all(end <= lo or hi <= i for *_, lo, hi in taken):
            taken.append((licence, name, -dice, i, end))
    return taken


def brute_scan(text, t, inside_lines):
    lines = [(k, w) for k, x in enumerate(text.split("\n")) if (w := licences.words(x))]
    best = brute_lines(lines, t)
    whole, of = [x for _, w in lines for x in w], [k for k, w in lines for _ in w]
    inside = {}
    for licence, name, dice, i, end in brute_words(whole, t) if inside_lines else ():
        if licence not in best and (licence not in inside or (-dice, i) < (-inside[licence][1], inside[licence][2])):
            inside[licence] = (name, dice, i, end)
    for licence, (name, dice, i, end) in inside.items():
        best[licence] = (name, dice, of[i], of[end - 1] - of[i] + 1)
    return sorted((licence, *found) for licence, found in best.items())


SMALL = {"A": ("a b c d", "b c d e f g"), "B": ("c c c d", "a a"), "C": ("x a b c y a b c z",)}


@pytest.mark.parametrize("inside_lines", [False, True])
def test_licences_match_brute_force(inside_lines):
    rng = random.Random(11)
    t, found = licences.compiled(SMALL, 0.7), 0
    for _ in range(400):
        some = [w for _ in range(rng.randint(0, 4)) for w in rng.choice([x for v in SMALL.values() for x in v]).split() + ["z"] if rng.random() < 0.9]
        text = "".join(w + rng.choice("   \n") for w in some)
        want = brute_scan(text, t, inside_lines)
        assert sorted(licences.scan(text, t, inside_lines)) == want, text
        found += len(want)
    assert found > 100


def test_licence_query_matches_brute_force(spark, corpus):
    rng = random.Random(12)
    notices = [x for v in licences.TEMPLATES.values() for x in v if len(x) < 200]
    texts = [r.text or "" for r in corpus.where("length(text) < 600").collect()]
    texts += [f"{prose(rng, 9)} {rng.choice(notices)}\n{rng.choice(notices).upper()} and {prose(rng, 5)}\n{rng.choice(notices)}" for _ in range(12)]
    t = licences.compiled(licences.TEMPLATES, licences.THRESHOLD)
    want = Counter((k, *f) for k, x in enumerate(texts) for f in brute_scan(x, t, True))
    got = licences.find(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), inside_lines=True)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 12


@pytest.mark.parametrize("line", ["Licensed under the MIT License.", "of the Software", "under CC BY 4.0"])
@pytest.mark.parametrize("between", ["\n", " "])
def test_equal_lines_take_time_in_proportion(line, between):
    t = licences.compiled(licences.TEMPLATES, licences.THRESHOLD)
    begun = time.monotonic()
    found = licences.scan(between.join([line] * 20_000), t, True)
    assert time.monotonic() - begun < 30
    few = licences.scan(between.join([line] * 3), t, True)
    assert [f[:4] for f in found] == [f[:4] for f in few]


def test_secrets_of_a_text_with_many(spark):
    rng = random.Random(13)
    kinds = [lambda: "%032x" % rng.getrandbits(128), lambda: "AKIA" + "%016X" % rng.getrandbits(64), lambda: "token = " + "%024x" % rng.getrandbits(96), lambda: "é secret:ab", lambda: prose(rng, 2)]
    texts = [" ".join(rng.choice(kinds)() for _ in range(n)) for n in (0, 1, 2, 255, 256, 257, 511, 513, 3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = secrets.find(df, spans="spans").withColumn("clean", secrets.redact(F.col("text"), F.col("spans"))).collect()
    for r in found:
        assert [tuple(s) for s in r.spans] == sorted(base_spans(r.text) + added_spans(r.text))
        assert r.clean == masked(r.text)


def test_fifty_thousand_secrets(spark):
    rng = random.Random(14)
    hashes = ["%032x" % rng.getrandbits(128) for _ in range(50_000)]
    df = spark.createDataFrame([(1, " ".join(hashes))], "doc_id bigint, text string")
    begun = time.monotonic()
    r = secrets.find(df, spans="spans").select(F.transform("spans", lambda s: s["start"]).alias("starts"), secrets.redact(F.col("text"), F.col("spans")).alias("clean")).first()
    assert time.monotonic() - begun < 60
    assert r.starts == list(range(0, 33 * 50_000, 33))
    assert r.clean == " ".join(["[SECRET]"] * 50_000)
