"""Passages that occur more than once: documents are parsed into factors relative to an index of the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm import rows
from vectable.session import cut_lineage

WINDOW = 35
#: Words of the runs that choose the block a window is indexed in.
GRAM = 6
#: Bytes of words of a task that are looked up among each other before they are exchanged, and bytes that are matched at once.
LOCAL_BYTES = 1 << 25
BLOCK_BYTES = 1 << 22
#: A block that more texts have is exchanged by its windows.
HOT_TEXTS = 1 << 14
SPAN = "struct<first_word:bigint,n_words:bigint,source:bigint,source_word:bigint>"


def words_of(s: rows.Slice) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, doc = rows.word_bounds(s.data, s.offsets, ~rows.SPACE[s.data])
    return rows.word_hashes(s.data, starts, ends), doc


def window_blocks(words: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is a window of one text, block of the window, hashes of the word runs), by first word.

    The block of a window is the least hash of the word runs inside it, so
    that windows of equal words share a block wherever they stand.
    """
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, bool), np.empty(0, np.uint64), np.empty(0, np.uint64)
    grams = rows.run_hashes(words, min(GRAM, window))
    return doc[:n] == doc[window - 1 :], rows.sliding(grams, window - min(GRAM, window) + 1, np.minimum), grams


def block_entries(words: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, block, more than once): the blocks of every text, each where a word run has chosen it."""
    valid, block, grams = window_blocks(words, doc, window)
    if not valid.any():
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    pad = np.zeros(len(grams) - len(block), np.uint64)
    chosen = rows.sliding(np.concatenate((pad, np.where(valid, block, np.uint64(0)), pad)), len(pad) + 1, np.maximum)
    at = np.flatnonzero(chosen == grams)
    text, value = doc[at], grams[at]
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    first = np.ones(len(at), bool)
    first[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    again = np.diff(np.append(np.flatnonzero(first), len(at))) > 1
    return text[first], value[first], again


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows.counts_to_offsets(counts)), pa.array(values, kind))


def read_texts(df: DataFrame, id_col: str, text: str, window: int) -> DataFrame:
    """(id, k1, k2, n_words, whole, blocks, again): two hashes of the text, its words, and its blocks of the index."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in rows.slices(batch.column(3)):
                words, doc = words_of(s)
                n = s.last - s.first
                text_of, value, again = block_entries(words, doc, window)
                whole = [hashlib.sha256(b" ".join(s.data[a:b].tobytes().split())).digest() for a, b in zip(s.offsets, s.offsets[1:])]
                columns = [c.slice(s.first, n) for c in batch.columns[:3]]
                entries = np.bincount(text_of, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.bincount(doc, minlength=n), pa.int64()), pa.array(whole, pa.binary()), lists(rows.signed(value), entries, pa.int64()), lists(again, entries, pa.bool_())],
                    ["id", "k1", "k2", "n_words", "whole", "blocks", "again"],
                )

    return keyed(df, id_col, text).mapInArrow(run, f"id {kind}, k1 bigint, k2 bigint, n_words bigint, whole binary, blocks array<bigint>, again array<boolean>")


def keyed(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, k1, k2, text): two 64-bit hashes stand for a text; NULL reads as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("second"), t).alias("k2"), F.col(text).alias("text"))


def stretches(words: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, end, block): the runs of neighbouring windows of one text that are in one block."""
    valid, block, _ = window_blocks(words, doc, window)
    if not len(valid):
        return np.empty(0, np.int64), np.empty(0, np.int64), block
    cut = np.ones(len(valid), bool)
    cut[1:] = (block[1:] != block[:-1]) | (doc[1 : len(valid)] != doc[: len(valid) - 1]) | ~valid[1:] | ~valid[:-1]
    first = np.flatnonzero(cut)
    end = np.append(first[1:], len(valid))
    return first[valid[first]], end[valid[first]], block[first[valid[first]]]


STRETCH = "key bigint, row bigint, start bigint, n bigint, alone boolean, words binary, source bigint, source_start bigint"


def exchanged(picked: DataFrame, window: int) -> DataFrame:
    """(key, row, start, n, alone, words, source, source_start): what every text has in shared blocks, in words.

    A row is a stretch of n windows from word `start` on, under the key of
    its block.  A block that very many texts have is taken apart: its windows
    are rows of their own, under a hash of theirs.  What a task meets again
    has its first place as its source and goes on without words, under a key of its own;
    the first place goes on with the second as its source.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready() -> pa.RecordBatch:
            for at, words in enumerate(out[5]):
                again = second.get(words) if words is not None else None
                if again is not None:
                    out[6][at], out[7][at] = again
            columns = [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in STRETCH.split(", ")])

        out: list[list] = [[] for _ in range(8)]
        known: dict[bytes, tuple[int, int]] = {}
        second: dict[bytes, tuple[int, int]] = {}
        size = 0
        for batch in batches:
            row, alone = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s in rows.slices(batch.column(2)):
                starts, ends, doc = rows.word_bounds(s.data, s.offsets, ~rows.SPACE[s.data])
                hashes = rows.word_hashes(s.data, starts, ends)
                begin, end, block = stretches(hashes, doc, window)
                of_text = np.searchsorted(doc, np.arange(s.last - s.first + 1))
                for k in range(s.last - s.first):
                    lo, hi = np.searchsorted(begin, of_text[k : k + 2])
                    cold, hot = (batch.column(c)[s.first + k].values.to_numpy().view(np.uint64) for c in (3, 4))
                    mine = np.arange(lo, hi)
                    parts = [(block[i], begin[i], end[i]) for i in mine[np.isin(block[mine], cold)]]
                    for i in mine[np.isin(block[mine], hot)]:
                        ones = rows.run_hashes(hashes[begin[i] : end[i] + window - 1], window)
                        parts += [(h, p, p + 1) for h, p in zip(ones, range(begin[i], end[i]))]
                    for key, first, last in parts:
                        words = b" ".join(s.data[starts[first] : ends[last + window - 2]].tobytes().split())
                        place = (row[s.first + k], int(first - of_text[k]))
                        source = known.setdefault(words, place)
                        again = source is not place
                        if again:
                            second.setdefault(words, place)
                            if not alone[s.first + k]:
                                continue
                            key = rows.mixed(np.array([place[0] ^ (place[1] << 20)], np.int64).view(np.uint64))[0]
                        values = (int(key.view(np.int64)), *place, int(last - first), alone[s.first + k], None if again else words, *(source if again else (None, None)))
                        for column, v in zip(out, values):
                            column.append(v)
                        size += 0 if again else len(words)
                if size >= LOCAL_BYTES:
                    yield ready()
                    out, known, second, size = [[] for _ in range(8)], {}, {}, 0
        yield ready()

    return picked.select("row", "alone", "text", "blocks", "hot_blocks").mapInArrow(run, STRETCH)


def matched(block: pa.Table, window: int) -> list[np.ndarray]:
    """[row, start, n, source, source_start]: the runs of windows in these stretches that stand elsewhere as well.

    All windows of the stretches are an index by 128-bit hash.  A run goes on
    as long as the next window has the next place of the same source; where
    it ends, the words of both places are compared.
    """
    row, start, n = (block[c].to_numpy() for c in ("row", "start", "n"))
    alone = block["alone"].to_numpy(zero_copy_only=False)
    known = block["source"].is_valid().to_numpy(zero_copy_only=False)
    whole = known & alone
    source, source_start = (block[c].fill_null(0).to_numpy()[whole] for c in ("source", "source_start"))
    found = [[row[whole], start[whole], n[whole], source, source_start]]
    texts = block["words"].combine_chunks()
    full = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
    s = next(rows.slices(pc.cast(texts.take(pa.array(full)), pa.large_binary()).view(pa.large_string()), 1 << 62), None)
    if s is None:
        return found[0]
    starts, ends, doc = rows.word_bounds(s.data, s.offsets, ~rows.SPACE[s.data])
    h, g = (rows.run_hashes(rows.word_hashes(s.data, starts, ends, seed), window) for seed in (0, 1))
    inside = np.flatnonzero(doc[: len(h)] == doc[window - 1 :]) if len(h) else np.empty(0, np.int64)
    order = inside[np.lexsort((g[inside], h[inside]))]
    if not len(order):
        return found[0]
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    group = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    many = np.diff(np.append(heads, len(order)))[group] > 1
    # The first place of a window is the source of all others, and the second that of the first.
    other = np.where(new, np.minimum(np.arange(len(order)) + 1, len(order) - 1), heads[group])
    asked = alone[full] & ~known[full]
    keep = many & asked[doc[order]]
    place, from_ = order[keep], order[other[keep]]
    by_place = np.argsort(place)
    place, from_ = place[by_place], from_[by_place]
    if not len(place):
        return found[0]
    goes_on = (np.diff(place) == 1) & (np.diff(from_) == 1) & (np.diff(doc[place]) == 0) & (np.diff(doc[from_]) == 0)
    first = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    last = np.append(first[1:], len(place)) - 1
    a, b = ([s.data[starts[p[i]] : ends[p[j] + window - 1]].tobytes() for i, j in zip(first, last)] for p in (place, from_))
    same = np.array([x == y for x, y in zip(a, b)])
    first, last = first[same], last[same]
    word = np.searchsorted(doc, np.arange(len(full)))

    def at(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stretch = doc[p]
        return row[full[stretch]], start[full[stretch]] + p - word[stretch]

    found.append([*at(place[first]), last - first + 1, *at(from_[first])])
    return [np.concatenate(c) for c in zip(*found)]


def runs_of(stretched: DataFrame, window: int) -> DataFrame:
    """(row, start, n, source, source_start): n windows in a row, and another place where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in rows.whole_keys(batches, "key", BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in matched(block, window)], ["row", "start", "n", "source", "source_start"])

    return stretched.repartition("key").sortWithinPartitions("key", "row", "start").mapInArrow(run, "row bigint, start bigint, n bigint, source bigint, source_start bigint")


def factors(start: np.ndarray, n: np.ndarray, source: np.ndarray, source_start: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The greedy parse: (first word, words, source, first word there) of every factor of at least a window.

    Given are runs of n windows from `start` on that the index knows, each
    with a place where it stands as well.  From the first such window on, a
    factor copies from that place as long as the next window is known one
    word further in the same source.  At its end the next window is checked
    on its own: if another source has it, the next factor begins there and
    overlaps this one; if none has, up to the next known window words are literals.
    """
    order = np.argsort(start, kind="stable")
    start, n, source, source_start = (c[order].astype(np.int64) for c in (start, n, source, source_start))
    if not len(start):
        return start, n, source, source_start
    goes_on = (start[1:] == start[:-1] + n[:-1]) & (source[1:] == source[:-1]) & (source_start[1:] == source_start[:-1] + n[:-1])
    begin = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    end = np.append(begin[1:], len(start)) - 1
    return start[begin], start[end] + n[end] - start[begin] + window - 1, source[begin], source_start[begin]


def cut_factors(found: DataFrame, window: int) -> DataFrame:
    """(row, n_removed, kept, spans) from (row, text, runs): the text is parsed, and the words of its factors are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept, parsed, counts = [], [], [], []
            for k, text in enumerate(batch.column(1)):
                words = (text.as_py() or "").encode().split()
                w = batch.column(2)[k].values
                parsed.append(factors(*[w.field(c).to_numpy() for c in ("start", "n", "source", "source_start")], window))
                first, n = parsed[-1][:2]
                covered = np.zeros(len(words) + 1, np.int64)
                np.add.at(covered, first, 1)
                np.add.at(covered, first + n, -1)
                gone = np.cumsum(covered)[:-1] > 0
                removed.append(int(gone.sum()))
                kept.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).digest())
                counts.append(len(first))
            columns = [np.concatenate([*c, np.empty(0, np.int64)]).astype(np.int64) for c in zip(*parsed)] if parsed else [np.empty(0, np.int64)] * 4
            spans = pa.ListArray.from_arrays(pa.array(rows.counts_to_offsets(np.array(counts, np.int64))), pa.StructArray.from_arrays([pa.array(c) for c in columns], ["first_word", "n_words", "source", "source_word"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()), spans], ["row", "n_removed", "kept", "spans"])

    return found.select("row", "text", "runs").mapInArrow(run, f"row bigint, n_removed bigint, kept binary, spans array<{SPAN}>")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, text_no, spans) for every row of df.

    A run of `window` words that stands anywhere else as well, in the same
    text or another row, is removed wherever it stands; kept_sha256 is the
    hash of the other words joined by one space.  NULL texts have no words.
    Rows with the same text are copies of each other: if it has a window,
    they lose all words.  Rows without an id are treated like others.
    spans are the removed factors: first word, number of words, and the text
    (its text_no) and word that the factor also stands at.  A copied text is
    one factor without a source.  text_no is NULL for texts that share no block.

    The corpus is the reference.  It is indexed in blocks: a window belongs
    to the block named by its least word-run hash, which equal windows share.
    Blocks that only one place of the corpus has are left out.  What texts
    have in the others is exchanged once, in words, and matched against all
    that the block holds: every run of windows gets a place where its words
    stand as well.  Stretches that a task meets more than once are
    answered there, so a frequent one costs a row a task, and blocks of more
    than `HOT_TEXTS` texts are taken apart into their windows.  The runs of a
    text are then parsed into factors.  Texts that stand in many
    rows are indexed once.  Texts cross the network once, keyed by id and
    text, so that copies spread; they are never checkpointed.
    """
    read = cut_lineage(read_texts(df, id_col, text, window))
    copies = cut_lineage(read.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("id").alias("first_id")))
    entries = read.select("k1", "k2", F.inline(F.arrays_zip(F.col("blocks").alias("block"), F.col("again").alias("again"))))
    shared = entries.groupBy("block").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"), F.max(F.col("again").cast("int")).alias("again"), F.count("*").alias("texts"))
    shared = cut_lineage(shared.where("lo <> hi or again = 1").select("block", (F.col("texts") > hot_texts).alias("hot")))
    sides = [F.collect_set(F.when(side, F.col("block"))).alias(name) for side, name in ((~F.col("hot"), "blocks"), (F.col("hot"), "hot_blocks"))]
    asked = entries.select("k1", "k2", "block").join(shared, "block").groupBy("k1", "k2").agg(*sides).join(copies, ["k1", "k2"])
    asked = cut_lineage(asked).withColumn("row", F.monotonically_increasing_id())
    names = asked.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), "first_id", "row", (F.col("copies") == 1).alias("alone"), "blocks", "hot_blocks")

    texts = keyed(df, id_col, text)
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2"))
    found = runs_of(exchanged(texts.join(names.hint("shuffle_hash"), same), window), window)
    runs = found.groupBy("row").agg(F.collect_list(F.struct("start", "n", "source", "source_start")).alias("runs"))
    losing = names.drop("blocks", "hot_blocks", "alone").join(runs, "row")
    parsed = cut_lineage(cut_factors(texts.join(losing.hint("shuffle_hash"), same), window))

    empty = hashlib.sha256(b"").digest()
    numbered = asked.select("k1", "k2", "row").join(parsed, "row", "left")
    of_text = cut_lineage(copies.select("k1", "k2", "copies").join(numbered, ["k1", "k2"], "left").where((F.col("copies") > 1) | F.col("row").isNotNull()))
    every = (F.col("copies") > 1) & (F.col("n_words") >= window)
    unknown = F.lit(None).cast("bigint")
    all_words = F.array(F.struct(F.lit(0).cast("bigint").alias("first_word"), F.col("n_words").alias("n_words"), unknown.alias("source"), unknown.alias("source_word")))
    return read.select("id", "k1", "k2", "n_words", "whole").join(of_text, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(every, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.lower(F.hex(F.when(every, F.lit(empty)).otherwise(F.coalesce("kept", "whole")))).alias("kept_sha256"),
        F.col("row").alias("text_no"),
        F.when(every, all_words).otherwise(F.coalesce("spans", F.array().cast(f"array<{SPAN}>"))).alias("spans"),
    )
