"""SimHash groups, repeated passages and benchmark passages against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_texts import prose

from vectable.llm import decontamination, graph, repeats, rows, simhash

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def print_of(text):
    words = SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def groups(fps, reach=3):
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= reach:
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_simhash_components(corpus):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    fps = [print_of(t) for _, t in docs]
    of = groups(fps)
    least = {g: min((d for (d, _), o in zip(docs, of) if o == g and d is not None), default=None) for g in set(of)}
    want = Counter((d, format(f, "016x"), least[g]) for (d, _), f, g in zip(docs, fps, of))
    found = simhash.near_duplicates(corpus)
    got = Counter(tuple(r) for r in found.select("doc_id", simhash.hex_fingerprint("fp"), "component_id").collect())
    assert got == want


def test_simhash_keeps_one_of_each_group(clashing, no_rows):
    kept = simhash.deduplicate(clashing)
    assert kept.columns == clashing.columns
    ids = Counter(r.doc_id for r in kept.collect())
    components = {r.component_id for r in simhash.near_duplicates(clashing).collect() if r.doc_id is not None}
    assert ids.pop(None) == 2
    assert ids == Counter(components)
    assert simhash.deduplicate(no_rows).count() == 0
    assert simhash.near_duplicates(no_rows).count() == 0


@pytest.mark.parametrize("shard_rows", [16, 10_000])
def test_simhash_shards_lose_no_link(spark, shard_rows, monkeypatch):
    """Random fingerprints with planted neighbours, and a dense ball far larger than a block."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 64, 250, np.uint64, endpoint=False)
    flip = np.array([sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 5)), replace=False)) for _ in base], np.uint64)
    ball = base[0] ^ np.array([(1 << a) ^ (1 << b) for a, b in itertools.combinations(range(20), 2)], np.uint64)
    fps = np.unique(np.concatenate((base, base ^ flip, ball)))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint").repartition(4)
    links = simhash.links(df, len(fps), shard_rows)
    found = {r.node: r.root for r in graph.components(links).collect()}
    of = groups([int(x) for x in fps])
    got = {}
    for k, x in enumerate(fps.view(np.int64).tolist()):
        got.setdefault(found.get(x, x), set()).add(k)
    want = {}
    for k, g in enumerate(of):
        want.setdefault(g, set()).add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert links.count() <= 40 * len(fps)


@pytest.mark.parametrize("chunk", [1 << 20, 50])
def test_components_of_long_chains_and_hubs(spark, monkeypatch, chunk):
    monkeypatch.setattr(graph, "CHUNK_LINKS", chunk)
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(300)]
    hub = [(1000, 1000 + k) for k in range(1, 400)]
    loops = [(5000, 5000), (6001, 6000), (6001, 6000)]
    links = chain + hub + loops
    rng.shuffle(links)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {got[k] for k in range(301)} == {0}
    assert {got[1000 + k] for k in range(400)} == {1000}
    assert got[6001] == 6000 and 5000 not in got
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def cut(texts, window):
    words = [SPLIT.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [35, 8, 4])
def test_repeats_are_cut_exactly(corpus, window):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    want = Counter((d, *c) for (d, _), c in zip(docs, cut([t for _, t in docs], window)))
    found = repeats.remove_repeats(corpus, window=window)
    got = found.collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    for r in got:
        covered = set().union(*[range(s.first_word, s.first_word + s.n_words) for s in r.spans], ())
        assert len(covered) == r.n_removed


def test_repeats_odd_tables(clashing, no_rows):
    assert repeats.remove_repeats(no_rows).count() == 0
    assert repeats.remove_repeats(clashing).count() == clashing.count()


def test_rows_of_one_id_keep_the_least_text(spark):
    """The id of a group's first document may stand on several rows: the least text stays, and of equal texts the least row."""
    rows = [(1, "zeta " * 30, 5), (1, "alpha beta " * 20, 7), (1, "alpha beta " * 20, 6), (2, "alpha beta " * 20, 1), (3, None, 1), (3, "", 2), (None, "alone", 0), (None, "alone", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(3)
    got = sorted(map(tuple, simhash.deduplicate(df).collect()), key=str)
    assert got == sorted([(1, "alpha beta " * 20, 6), (3, None, 1), (None, "alone", 0), (None, "alone", 0)], key=str)


def test_slices_and_word_hashes():
    texts = ["a bb  ccc", None, "", " x", "y " * 3000, "bb"]
    got = []
    for s in rows.slices(pa.array(["skipped", *texts]).slice(1), 16):
        starts, ends, doc = rows.word_bounds(s.data, s.offsets, ~rows.SPACE[s.data])
        h = rows.word_hashes(s.data, starts, ends)
        got += [(s.first + d, bytes(s.data[a:b]).decode(), x) for d, a, b, x in zip(doc, starts, ends, h)]
    assert [(d, w) for d, w, _ in got] == [(k, w) for k, t in enumerate(texts) for w in SPLIT.findall(t or "")]
    by_word = {}
    for _, w, x in got:
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)


def test_every_tolerated_passage_meets_a_seed():
    """Longer runs hold one of 13 to 25 tokens that agrees as well, so these lengths stand for all."""
    for n in range(13, 26):
        places = [sum(1 << (p + k) for k, bit in enumerate(m) if bit == "1") for m in decontamination.MASKS for p in range(n - len(m) + 1)]
        for wrong in itertools.combinations(range(n), n // 5):
            bits = sum(1 << x for x in wrong)
            assert any(bits & p == 0 for p in places)


def best_overlaps(text, item):
    a, b = (re.findall(r"[0-9a-z\u0080-\U0010ffff]+", t.lower()) for t in (text or "", item or ""))
    best = None
    if len(b) < 5:
        return None
    for shift in range(-len(b) + 1, len(a)):
        lo, hi = max(0, -shift), min(len(b), len(a) - shift)
        eq = [a[k + shift] == b[k] for k in range(lo, hi)]
        total = [0, *itertools.accumulate(5 * e - 4 for e in eq)]
        runs = [(j - i, -i) for i in range(len(eq)) for j in range(i + 1, len(eq) + 1) if total[j] >= total[i]]
        if runs:
            n, i = max(runs)
            if n >= 13 or (n == len(b) and all(eq)):
                found = (n, sum(eq[-i : n - i]), -(lo + shift - i))
                best = max(best or found, found)
    return best


def planted(seed):
    rng = random.Random(seed)
    items = [(k, prose(rng, n)) for k, n in enumerate([40, 25, 13, 12, 7, 5, 3, 0, 30])] + [(9, None), (10, None)]
    items.append((11, items[0][1]))
    docs = []
    for k in range(60):
        words = prose(rng, rng.randint(0, 60)).split()
        piece = (rng.choice(items)[1] or "").split()
        piece = piece[rng.randint(0, 4) :] if rng.random() < 0.4 else piece
        piece = ["other" if rng.random() < rng.choice([0, 0.1, 0.25]) else w for w in piece]
        at = rng.randint(0, len(words))
        docs.append((k, ", ".join(words[:at]) + " " + " ".join(piece).upper() + "!\n" + " ".join(words[at:])))
    return docs + [(60, None), (61, ""), (None, items[0][1]), (62, items[0][1]), (62, items[0][1])], items


@pytest.mark.parametrize("most_bits", [decontamination.MOST_BITS, 7])
def test_benchmark_passages(spark, most_bits):
    docs, items = planted(5)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    t = spark.createDataFrame(items, "item_id int, text string")
    want = Counter((i, k, *b) for i, text in docs for k, item in items if (b := best_overlaps(text, item)))
    assert len(want) > 30
    got = decontamination.contamination(d, t, most_bits=most_bits).collect()
    assert Counter((r.doc_id, r.item_id, r.n_tokens, r.n_equal, -r.start) for r in got) == want
    stay = decontamination.uncontaminated(d, t, most_bits=most_bits)
    assert stay.columns == d.columns
    dirty = {(i, text) for i, text in docs for _, item in items if best_overlaps(text, item)}
    assert Counter(map(tuple, stay.collect())) == Counter(x for x in docs if x not in dirty)


def test_benchmark_odd_tables(spark, clashing, no_rows):
    t = spark.createDataFrame([], "item_id int, text string")
    assert decontamination.contamination(clashing, t).count() == 0
    assert decontamination.uncontaminated(clashing, t).count() == clashing.count()
    assert decontamination.contamination(no_rows, spark.createDataFrame([(1, "a b c d e f g")], t.schema)).count() == 0
