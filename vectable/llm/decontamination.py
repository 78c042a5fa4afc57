"""Passages of a test set inside training texts, by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm import rows
from vectable.session import cut_lineage

# The seeds, 1 for a token that has to agree, 0 for one that is ignored.  One of them fits
# into every run of 13 or more tokens of which four in five agree, wherever the others are (tested).
MASKS = ("11000001101", "10110101", "1100110001")
MIN_TOKENS = 13
SHORTEST_ITEM = 5
#: A passage agrees if at least this many fifths of its tokens do.
FIFTHS = 4
#: The filter of the test seeds has at most 2**MOST_BITS bits (8 MB); more seeds let more texts pass, which costs time only.
MOST_BITS = 26
PROBES = 4


def token_table() -> np.ndarray:
    """Bytes of tokens: ASCII letters and digits, and everything beyond ASCII."""
    t = np.zeros(256, bool)
    for lo, hi in ((ord("0"), ord("9")), (ord("a"), ord("z")), (0x80, 0xFF)):
        t[lo : hi + 1] = True
    return t


TOKEN = token_table()


def tokens(s: rows.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of the lower-cased texts, and the text it is in."""
    starts, ends, doc = rows.word_bounds(s.data, s.offsets, TOKEN[s.data])
    return rows.word_hashes(s.data, starts, ends), doc


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the tokens under the mask at every place where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, len(mask), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h = rows.mixed(h) ^ words[k : k + n]
    return rows.mixed(h)


def lengths_below(n: int) -> list[str]:
    """The masks of items that are too short for the others: all tokens of the item."""
    return ["1" * k for k in range(SHORTEST_ITEM, n)]


#: Every mask with its number, which is part of a seed.
ALL_MASKS = (*MASKS, *lengths_below(MIN_TOKENS))


def keyed_seeds(words: np.ndarray, number: int) -> np.ndarray:
    return rows.mixed(seed_hashes(words, ALL_MASKS[number]) ^ np.uint64(number))


def probes(keys: np.ndarray, bits: int) -> np.ndarray:
    """(PROBES, keys): the bits of a filter of 2**bits bits that a key sets."""
    step = rows.mixed(keys) | np.uint64(1)
    return np.stack([(keys + np.uint64(k) * step) >> np.uint64(64 - bits) for k in range(PROBES)])


@dataclass
class Filter:
    """A bit array of bounded size that every seed of the test set passes; of others few do as long as there are fewer seeds than bits."""

    bits: int
    words: np.ndarray
    masks: tuple[int, ...]

    def passes(self, keys: np.ndarray) -> np.ndarray:
        at = np.arange(len(keys))
        for k in range(PROBES):
            place = probes(keys[at], self.bits)[k]
            at = at[(self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
        return at


def read_items(tests: DataFrame, item_text: str) -> DataFrame:
    """(item, k1, k2, words): the token hashes of every different text of the test set, with a number."""
    keyed = tests.select(F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct()
    keyed = keyed.select(*text_keys(F.col("text")), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in rows.slices(pc.utf8_lower(batch.column(2))):
                h, doc = tokens(s)
                counts = np.bincount(doc, minlength=s.last - s.first)
                yield pa.RecordBatch.from_arrays([*[c.slice(s.first, s.last - s.first) for c in batch.columns[:2]], hash_lists(h, counts)], ["k1", "k2", "words"])

    found = keyed.mapInArrow(run, "k1 bigint, k2 bigint, words array<bigint>").where(F.size("words") >= SHORTEST_ITEM)
    return cut_lineage(found).withColumn("item", F.monotonically_increasing_id())


def text_keys(text: Column) -> list[Column]:
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("second"), t).alias("k2")]


def hash_lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows.counts_to_offsets(counts)), pa.array(rows.signed(values), pa.int64()))


def seeds_of(items: DataFrame) -> DataFrame:
    """(key, mask, item, place): the seeds of all items; an item shorter than 13 tokens is also one as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column(0), batch.column(1)):
                words = value.values.to_numpy().view(np.uint64)
                for number, mask in enumerate(ALL_MASKS):
                    if number >= len(MASKS) and len(mask) != len(words):
                        continue
                    key = rows.signed(keyed_seeds(words, number))
                    if n := len(key):
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(n, number)), pa.array(np.full(n, item.as_py())), pa.array(np.arange(n))], ["key", "mask", "item", "place"])

    return items.select("item", "words").mapInArrow(run, "key bigint, mask bigint, item bigint, place bigint")


def fit_filter(seeds: DataFrame, most_bits: int) -> Filter:
    """The filter of all seeds: 16 bits for each, but at most 2**most_bits; its words are put together by Spark."""
    sizes = {r["mask"]: r["count"] for r in seeds.groupBy("mask").count().collect()}
    bits = min(most_bits, max(10, (16 * sum(sizes.values())).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = probes(batch.column(0).to_numpy().view(np.uint64), bits).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(rows.signed(place >> np.uint64(6))), pa.array(rows.signed(np.uint64(1) << (place & np.uint64(63))))], ["word", "bit"])

    set_ = seeds.select("key").mapInArrow(run, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
    words[set_["word"].to_numpy()] = set_["bit"].to_numpy().view(np.uint64)
    return Filter(bits, words, tuple(sorted(sizes)))


def seed_hits(s: rows.Slice, seeds: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, text of each, key, text and place of every seed that passes the filter)."""
    words, doc = tokens(s)
    first = np.searchsorted(doc, np.arange(s.last - s.first + 1))
    keys, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for number in seeds.masks:
        key = keyed_seeds(words, number)
        found = seeds.passes(key)
        found = found[doc[found] == doc[found + len(ALL_MASKS[number]) - 1]]
        keys.append(key[found])
        at.append(found)
    at = np.concatenate(at)
    return words, doc, np.concatenate(keys), doc[at], at - first[doc[at]]


SHADOW = ("__words", "__hits")


def with_hits(docs: DataFrame, text: str, seeds: Filter) -> DataFrame:
    """The rows of docs of which some seed passes the filter, with the token hashes and the seeds (key, place)."""
    sent = docs.sparkSession.sparkContext.broadcast(seeds)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in rows.slices(pc.utf8_lower(pc.cast(batch.column(at), pa.large_string()))):
                n = s.last - s.first
                words, doc, keys, of, place = seed_hits(s, sent.value)
                order = np.argsort(of, kind="stable")
                hits = pa.StructArray.from_arrays([pa.array(rows.signed(keys[order])), pa.array(place[order])], ["key", "place"])
                counts = np.bincount(of, minlength=n)
                hits = pa.ListArray.from_arrays(pa.array(rows.counts_to_offsets(counts)), hits)
                every = hash_lists(words, np.bincount(doc, minlength=n))
                out = pa.RecordBatch.from_arrays([*[c.slice(s.first, n) for c in batch.columns], every, hits], [*batch.schema.names, *SHADOW])
                yield out.filter(pa.array(counts > 0))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, __words array<bigint>, __hits array<struct<key:bigint,place:bigint>>")


def without_hits(docs: DataFrame, text: str, seeds: Filter) -> DataFrame:
    """The other rows of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(seeds)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for s in rows.slices(pc.utf8_lower(pc.cast(batch.column(at), pa.large_string()))):
                clean[s.first + seed_hits(s, sent.value)[3]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def longest_agreement(equal: np.ndarray) -> tuple[int, int]:
    """The longest run [start, end) in which at least four of five tokens agree; the first of equally long ones."""
    total = np.concatenate(([0], np.cumsum(5 * equal.astype(np.int64) - FIFTHS)))
    least = np.minimum.accumulate(total)
    start = np.searchsorted(-least, -total, "left")
    length = np.arange(len(total)) - start
    end = int(length.argmax())
    return int(start[end]), end


def verify(words: np.ndarray, item: np.ndarray, item_tokens: int) -> tuple[int, int, int] | None:
    """(start, tokens, agreeing tokens) of the overlap of aligned tokens if it is long enough."""
    equal = words == item
    start, end = longest_agreement(equal)
    if end - start < MIN_TOKENS and not (end - start == item_tokens and equal.all()):
        return None
    return start, end - start, int(equal[start:end].sum())


def verified(pairs: DataFrame) -> DataFrame:
    """(row, item, start, n_tokens, n_equal, item_tokens) of the alignments (row, item, at, item_tokens, words, item_words) that hold a passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k, (words, item, n) in enumerate(zip(batch.column(4), batch.column(5), batch.column(3))):
                passage = verify(words.values.to_numpy(), item.values.to_numpy(), n.as_py())
                if passage:
                    found.append((k, *passage))
            if found:
                at, start, n, equal = (np.array(c) for c in zip(*found))
                kept = batch.take(pa.array(at))
                begin = kept.column(2).to_numpy() + start
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(begin), pa.array(n), pa.array(equal), kept.column(3)], ["row", "item", "start", "n_tokens", "n_equal", "item_tokens"])

    picked = pairs.select("row", "item", "at", "item_tokens", "words", "item_words")
    return picked.mapInArrow(run, "row bigint, item bigint, start bigint, n_tokens bigint, n_equal bigint, item_tokens bigint")


def passages(candidates: DataFrame, items: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row, item, start, n_tokens, n_equal, item_tokens): the longest passage of every row (row, __words, __hits) and item that share one.

    Seeds are joined with seeds; equal ones give an alignment of a text and an
    item.  Only the tokens that lie side by side are brought together, so a long
    text costs no more than the items it meets.
    """
    hits = candidates.select("row", F.inline("__hits"))
    met = hits.select("row", "key", F.col("place").alias("__at")).join(seeds.select("key", "item", "place"), "key")
    shifts = met.select("row", "item", (F.col("__at") - F.col("place")).alias("shift")).distinct()
    lo = F.greatest(F.lit(0), -F.col("shift"))
    sided = shifts.join(items.select("item", F.col("words").alias("item_words")), "item").join(candidates.select("row", F.col("__words").alias("words")), "row")
    n = F.least(F.size("item_words"), F.size("words") - F.col("shift")) - lo
    pairs = sided.select(
        "row", "item", (lo + F.col("shift")).alias("at"), F.size("item_words").cast("bigint").alias("item_tokens"),
        F.slice("words", (lo + F.col("shift") + 1).cast("int"), n.cast("int")).alias("words"), F.slice("item_words", (lo + 1).cast("int"), n.cast("int")).alias("item_words"),
    )
    best = F.max(F.struct(F.col("n_tokens"), F.col("n_equal"), (-F.col("start")).alias("start"), F.col("item_tokens")))
    longest = verified(pairs).groupBy("row", "item").agg(best.alias("b"))
    return longest.select("row", "item", (-F.col("b.start")).alias("start"), "b.n_tokens", "b.n_equal", "b.item_tokens")


def contamination(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """(id, item, start, n_tokens, n_equal, item_tokens): every document and test item that share a passage, with the longest one.

    A passage is a run of at least 13 aligned tokens in which at least four
    of five agree, or a whole item of 5 to 12 tokens in which all do.  Tokens
    are runs of letters and digits, lower-cased, all beyond ASCII taken as
    letters; start counts tokens of the document.  Items of fewer than five
    tokens are not looked for.  NULL and empty texts overlap nothing;
    repeated rows and items are reported each.

    The test set is a table of seeds.  A bit filter of them, at most
    2**most_bits bits, goes to the tasks; texts of which no seed passes it
    are read once and go nowhere.  The seeds of the others are joined with those of the test
    set, and aligned tokens are compared.  Equal items are looked for once.
    """
    items = read_items(tests, item_text)
    seeds = cut_lineage(seeds_of(items))
    found = with_hits(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text", fit_filter(seeds, most_bits))
    candidates = cut_lineage(found.select("id", *SHADOW)).withColumn("row", F.monotonically_increasing_id())
    shared = cut_lineage(passages(candidates, items, seeds))
    named = tests.select(F.col(item_col).alias("item_id"), *text_keys(F.col(item_text))).join(items.select("item", "k1", "k2"), ["k1", "k2"])
    out = shared.join(candidates.select("row", "id"), "row").join(named.select("item", "item_id"), "item")
    return out.select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), "start", "n_tokens", "n_equal", "item_tokens")


def uncontaminated(docs: DataFrame, tests: DataFrame, text: str = "text", item_text: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of docs that share no passage (see contamination) with any item; all columns as they are.

    Rows of which no seed passes the filter stay where they are read; only the others are looked at further.
    """
    items = read_items(tests, item_text)
    seeds = cut_lineage(seeds_of(items))
    sieve = fit_filter(seeds, most_bits)
    candidates = cut_lineage(with_hits(docs, text, sieve)).withColumn("__row", F.monotonically_increasing_id())
    shared = passages(candidates.select(F.col("__row").alias("row"), *SHADOW), items, seeds).select(F.col("row").alias("__row")).distinct()
    clean = candidates.join(cut_lineage(shared), "__row", "left_anti").select(*docs.columns)
    return without_hits(docs, text, sieve).unionByName(clean)
