"""Words one edit apart, found by walking a trie level by level, and the common form that each rare one varies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm.lines import ascii_lower
from vectable.operators.joins import join_unique
from vectable.session import cut_lineage, scratch_path

#: Runs of these are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_CHARS = 5
LEAST_COUNT = 3
#: Words up to this length are in the trie, one level a code point; pairs with a longer one meet by hashes of their rests.
TRIE_CHARS = 32
#: Ends of a word in the children of a node, and the marks of words read forwards and backwards.
END, FORWARDS, BACKWARDS = "", ">", "<"
#: Fixed values of the rolling hashes: a Mersenne prime and two bases.
PRIME = (1 << 61) - 1
BASES = (0x0D6E8FEB86659FD9, 0x1F51AFD7ED558CCD)


def runs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, run): every maximal run of letters of every text, A-Z in lower case.  A NULL text has none."""
    found = df.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(LETTERS), F.lit(0))).alias("run"))
    return found.select("id", ascii_lower(F.col("run")).alias("run"))


def without(word: Column, at: Column) -> Column:
    """The word without its code point `at` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))


def vocabulary(words: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def letter(t: Column, at: Column | int) -> Column:
    """Code point `at` (from 0) of a marked word; END behind the last one."""
    return F.substring(t, at + 2 if isinstance(at, Column) else F.lit(at + 2), F.lit(1))


def marked_words(vocab: DataFrame) -> DataFrame:
    """(t, start): every word forwards and backwards, and the first position at which that reading edits it.

    Edits of the second half are found forwards, those of the first half
    backwards.  So a walk leaves its own word below the crowded top of the
    trie, where a node has few children.
    """
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    both = F.array(
        F.struct(F.concat(F.lit(FORWARDS), "word").alias("t"), half.alias("start")),
        F.struct(F.concat(F.lit(BACKWARDS), F.reverse("word")).alias("t"), (size - half).alias("start")),
    )
    return vocab.where(size <= TRIE_CHARS).select(F.inline(both))


def write_edges(words: DataFrame, lowest: int, path: str) -> None:
    """The trie as a table of (node, children), a folder for each depth; a node is named by the letters that lead to it."""
    depth = F.explode(F.sequence(F.lit(lowest), F.char_length("t") - 1)).alias("depth")
    steps = words.select("t", depth).select("depth", F.substring("t", F.lit(1), F.col("depth") + 1).alias("node"), letter(F.col("t"), F.col("depth")).alias("child"))
    edges = steps.groupBy("depth", "node").agg(F.collect_set("child").alias("children"))
    edges.repartitionByRange("depth", "node").write.partitionBy("depth").parquet(path)


def moves(pos: Column, edits: Column, node: Column, t: Column, children: Column) -> Column:
    """The states that a state (t, pos, node, edits) goes on to, as an array.

    An edited state can only go on with its next letter; at the end of the
    word it is done if a word ends in its node.  An unedited one goes on
    with its next letter, leaves it out, or takes a later letter in its place
    (an earlier one is that word's own move).
    """

    def state(pos: Column, node: Column, edits: int, done: Column) -> Column:
        return F.struct(pos.cast("int").alias("pos"), node.alias("node"), F.lit(edits).alias("edits"), done.alias("done"))

    def go(at: Column) -> Column:
        here = letter(t, at)
        return F.when(F.array_contains(children, here), F.array(state(at + 1, F.concat(node, here), 1, here == END))).otherwise(none)

    none = F.array().cast("array<struct<pos:int,node:string,edits:int,done:boolean>>")
    here = letter(t, pos)
    own = F.array(state(pos + 1, F.concat(node, here), 0, F.lit(False)))
    replaced = F.transform(F.filter(children, lambda c: c > here), lambda c: state(pos + 1, F.concat(node, c), 1, F.lit(False)))
    fresh = F.when(here == END, none).otherwise(F.concat(own, go(pos + 1), replaced))
    return F.when(edits == 1, go(pos)).otherwise(fresh)


def trie_links(vocab: DataFrame) -> DataFrame:
    """(a, b), in one order each, of the words of up to TRIE_CHARS code points that are one edit apart; a link may repeat.

    The frontier holds states (word, position, node, edits).  Each level
    joins it with the edges of one depth; words enter it where their own
    edits begin.  A state whose edited word ends in a node that ends a word
    is a link.  Levels are checkpointed; there are as many as the longest word has code points.
    """
    spark = vocab.sparkSession
    words = cut_lineage(marked_words(vocab))
    bounds = words.agg(F.min("start").alias("lo"), F.max(F.char_length("t") - 1).alias("hi")).first()
    schema = "a string, b string"
    if bounds["lo"] is None:
        return spark.createDataFrame([], schema)
    path = scratch_path(spark, "trie")
    write_edges(words, bounds["lo"], path)
    edges = spark.read.schema("node string, children array<string>, depth int").parquet(path)
    found, frontier = [], None
    for depth in range(bounds["lo"], bounds["hi"] + 1):
        entering = words.where(F.col("start") == depth).select("t", F.lit(depth).alias("pos"), F.substring("t", 1, depth + 1).alias("node"), F.lit(0).alias("edits"))
        states = entering if frontier is None else frontier.unionByName(entering)
        met = states.join(edges.where(F.col("depth") == depth).select("node", "children"), "node")
        stepped = met.select("t", F.explode(moves(F.col("pos"), F.col("edits"), F.col("node"), F.col("t"), F.col("children"))).alias("m"))
        stepped = cut_lineage(stepped.select("t", "m.*"))
        found.append(stepped.where("done").select("t", "node"))
        frontier = stepped.where("NOT done").select("t", "pos", "node", "edits")
    links = found[0]
    for level in found[1:]:
        links = links.unionByName(level)

    def word(t: str) -> Column:
        bare = F.expr(f"substring({t}, 2)")
        return F.when(F.left(F.col(t), F.lit(1)) == FORWARDS, bare).otherwise(F.reverse(bare))

    return links.select(word("t").alias("a"), word("node").alias("b"))


def rests(word: str, base: int) -> tuple[int, list[int]]:
    """The rolling hash of a word, and those of the word without each of its code points."""
    points = [ord(c) + 1 for c in word]
    before, power = [0], [1]
    for p in points:
        before.append((before[-1] * base + p) % PRIME)
        power.append(power[-1] * base % PRIME)
    behind, out = 0, []
    for k in range(len(points) - 1, -1, -1):
        n = len(points) - 1 - k
        out.append((before[k] * power[n] + behind) % PRIME)
        behind = (behind + points[k] * power[n]) % PRIME
    return before[-1], out[::-1]


def long_links(vocab: DataFrame, least: int = TRIE_CHARS) -> DataFrame:
    """(a, b), in one order each, of words one edit apart of which one has more than `least` code points; a link may repeat.

    Two words of one length are one replacement apart if they are equal
    without the same position, others one deletion apart if the longer without a
    position is the shorter.  Both are joins of 122-bit hashes with at most one row for each letter of
    the alphabet and key; what meets is compared by its letters.
    """
    size = F.char_length("word")
    known = vocab.where(size >= least).select("word", F.xxhash64("word").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (whole, first), (whole2, second) = (rests(word, b) for b in BASES)
                n = len(word)
                if n > least:
                    for lo in range(0, n, 1 << 16):
                        part = slice(lo, min(n, lo + (1 << 16)))
                        m = part.stop - lo
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, key)), pa.array(np.full(m, n - 1)), pa.array(np.arange(lo, part.stop)), pa.array(first[part], pa.int64()), pa.array(second[part], pa.int64())],
                            ["id", "left", "pos", "k1", "k2"],
                        )
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([n]), pa.array([-1]), pa.array([whole], pa.int64()), pa.array([whole2], pa.int64())], ["id", "left", "pos", "k1", "k2"])

    keys = cut_lineage(known.mapInArrow(run, "id bigint, left bigint, pos bigint, k1 bigint, k2 bigint"))
    cut, whole = keys.where("pos >= 0"), keys.where("pos < 0")
    at = ["left", "k1", "k2"]
    shorter = cut.select(*at, F.col("id").alias("x")).join(whole.select(*at, F.col("id").alias("y")), at).select("x", "y")
    level = cut.select(*at, "pos", F.col("id").alias("x")).join(cut.select(*at, "pos", F.col("id").alias("y")), [*at, "pos"]).where("x < y").select("x", "y")
    pairs = shorter.unionByName(level).distinct()
    named = pairs.join(known.select(F.col("id").alias("x"), F.col("word").alias("a")), "x").join(known.select(F.col("id").alias("y"), F.col("word").alias("b")), "y")
    return named.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where the chain of forms ends.  Each round doubles the steps, so chains of 2**k need k rounds."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(join_unique(now, step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(vocab: DataFrame, least_ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of vocab (word, n); words are different and not empty.

    Words are near if they differ by one inserted, deleted or replaced code
    point; n_near counts them.  The form of a word is its near word of
    largest n (ties: the smallest in code-point order), if that n is at least
    `least_ratio` (2 or more, so that chains end) times its own; form and form_n are NULL otherwise.
    root is where following forms ends, the word itself without a form.
    """
    if least_ratio < 2:
        raise ValueError("least_ratio is at least 2")
    vocab = cut_lineage(vocab.select("word", F.col("n").cast("bigint").alias("n")))
    links = trie_links(vocab)
    if not vocab.where(F.char_length("word") > TRIE_CHARS).isEmpty():
        links = links.unionByName(long_links(vocab))
    links = cut_lineage(links.distinct())
    sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = sides.join(vocab.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    best = F.min_by(F.struct(F.col("b").alias("form"), F.col("n_b").alias("form_n")), F.struct(-F.col("n_b"), F.col("b")))
    near = counted.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    has = F.col("best.form_n") >= least_ratio * F.col("n")
    told = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(has, F.col("best.form")).alias("form"), F.when(has, F.col("best.form_n")).alias("form_n")
    )
    told = cut_lineage(told)
    ends = roots_of(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
