"""The parse into factors: what they copy, where they end, and words that a weak hash takes for one."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose
from test_near_text import SPLIT, cut

from vectable.llm import repeats, rows


def thue_morse(n, first="a", second="b"):
    word = first
    while len(word) < n:
        word += word.translate(str.maketrans({first: second, second: first}))
    return word


def test_words_that_polynomials_take_for_one(spark):
    """The Thue-Morse word and its complement are equal to every polynomial hash modulo a power of two."""
    shared = prose(random.Random(1), 34)
    docs = [(1, f"{shared} {thue_morse(2048)}"), (2, f"{shared} {thue_morse(2048, 'b', 'a')}"), (3, f"{shared} {thue_morse(2048)}")]
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(spark.createDataFrame(docs[:2], "doc_id bigint, text string")).collect()}
    assert got == {1: 0, 2: 0}
    docs[2] = (3, "before " + docs[2][1])
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {1: 35, 2: 0, 3: 35}


def test_hashes_tell_words_apart():
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 20))) for _ in range(20_000)} | {"a\0", "a", "a\0\0", "x" * 16, "x" * 17, "x" * 16 + "\0"}
    text = " ".join(sorted(words)).encode()
    s = next(iter(rows.slices(pa.array([text.decode()]), 1 << 30)))
    starts, ends, _ = rows.word_bounds(s.data, s.offsets, ~rows.SPACE[s.data])
    first, second = (rows.word_hashes(s.data, starts, ends, seed) for seed in (0, 1))
    assert len(set(first.tolist())) == len(set(second.tolist())) == len(words)
    assert not set(first.tolist()) & set(second.tolist())
    runs = rows.run_hashes(np.concatenate((first, first)), 35)
    assert len(set(runs[: len(words)].tolist())) == len(words) and (runs[len(words) :] == runs[: len(words) - 34]).all()
    assert rows.run_hashes(first[[0, 1] * 40], 35)[0] != rows.run_hashes(first[[1, 0] * 40], 35)[0]


def test_factors_end_where_the_source_does():
    start, n = np.array([7, 3, 5, 20, 6, 21]), np.array([1, 2, 1, 1, 1, 2])
    source = np.array([2, 1, 1, 1, 2, 1])
    at = np.array([51, 10, 12, 30, 50, 32])
    got = [x.tolist() for x in repeats.factors(start, n, source, at, 4)]
    assert got == [[3, 6, 20, 21], [6, 5, 4, 5], [1, 2, 1, 1], [10, 50, 30, 32]]
    none = np.empty(0, np.int64)
    assert [len(x) for x in repeats.factors(none, none, none, none)] == [0] * 4


def test_stretches_are_matched_in_words():
    """Runs go on while the source does, a stretch without words passes with its source, and the place in a copied text is only a source."""
    texts = ["a b c d e f", "x b c d e y", "c d e f", None, "q r s"]
    rows_in = [
        {"key": 1, "row": r, "start": at, "n": len((t or "a b c d").split()) - 2, "alone": r != 12, "words": t and t.encode(), "source": None if t else 10, "source_start": None if t else 0}
        for r, at, t in zip((10, 11, 12, 13, 14), (0, 5, 7, 3, 0), texts)
    ]
    schema = pa.schema([("key", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("alone", pa.bool_()), ("words", pa.binary()), ("source", pa.int64()), ("source_start", pa.int64())])
    got = {tuple(int(v) for v in r) for r in zip(*repeats.matched(pa.Table.from_pylist(rows_in, schema), 3))}
    assert got == {(10, 1, 2, 11, 6), (10, 3, 1, 12, 8), (11, 6, 2, 10, 1), (13, 3, 2, 10, 0)}


def test_keys_are_never_parted():
    batches = [pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(range(len(k)))], ["key", "v"]) for k in ([1, 1, 2], [2, 2, 3], [], [3], [3, 3], [4, 5, 5])]
    for least in (1, 60, 10_000):
        tables = list(rows.whole_keys(iter(batches), "key", least))
        keys = [t["key"].to_pylist() for t in tables]
        assert sum(keys, []) == [1, 1, 2, 2, 2, 3, 3, 3, 3, 4, 5, 5]
        assert sum(len(set(k)) for k in keys) == 5
    assert list(rows.whole_keys(iter([]), "key", 1)) == []


@pytest.mark.parametrize("hot_texts", [repeats.HOT_TEXTS, 3])
def test_factors_copy_from_their_source(spark, corpus, hot_texts):
    """Every factor stands in the text it names, at the word it names, whether a block is exchanged by stretches or by windows."""
    rng = random.Random(5)
    passage = prose(rng, 90)
    more = [(500 + k, f"{prose(rng, 20 + k)} {passage} {prose(rng, k)} {' '.join(passage.split()[: 40 + k])}", "en", "a", 0) for k in range(60)]
    docs = corpus.unionByName(spark.createDataFrame(more, corpus.schema)).repartition(4)
    texts = Counter(r.text for r in docs.collect())
    by_id = {r.doc_id: r.text for r in docs.collect()}
    found = repeats.remove_repeats(docs, hot_texts=hot_texts).collect()
    all_rows = docs.collect()
    want = cut([r.text for r in all_rows], repeats.WINDOW)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == Counter((r.doc_id, *c) for r, c in zip(all_rows, want))
    words = {r.text_no: SPLIT.findall(by_id[r.doc_id] or "") for r in found if r.text_no is not None and r.doc_id is not None}
    copied = 0
    for r in (r for r in found if r.doc_id is not None):
        for s in r.spans:
            if s.source is None:
                assert texts[by_id[r.doc_id]] > 1 and (s.first_word, s.n_words) == (0, r.n_words)
            elif s.source in words:
                own = SPLIT.findall(by_id[r.doc_id] or "")
                assert own[s.first_word :][: s.n_words] == words[s.source][s.source_word :][: s.n_words]
                assert (r.text_no, s.first_word) != (s.source, s.source_word) and s.n_words >= repeats.WINDOW
                copied += 1
    assert copied > 100
