"""Toxicity of texts: boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import string
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm import rows
from vectable.session import cut_lineage

#: Labelled rows that are learned from, about; and terms of a lexicon, at most.
SAMPLE_ROWS = 20_000
LEXICON_TERMS = 20_000
FOLDS = 4
STEMS = (6, 5, 4)
#: Lower confidence bound of a term's log-odds: standard errors taken off, and the least value kept.
ERRORS, LEAST_ODDS = 2.5, 0.3
TREES, DEPTH, STEP = 20, 3, 0.3
#: Share of the trees' own probability in a score; orders the texts inside one step of the isotonic curve.
SMOOTH = 0.02
MEMO = 200_000

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur du dich dir dein deine deinen ihr euch euer eure sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra os".split())
# Signs that stand for letters.
LETTER_FOR = str.maketrans("013457@$!", "oieastasi")
INNER = str.maketrans("", "", string.punctuation)
FEATURES = (
    "word_density", "word_weight", "word_most", "word_kinds", "stem_density", "stem_weight", "stem_most", "stem_kinds",
    "near_second_person", "nearest_second_person", "second_person_density", "capitals", "capital_words", "exclaiming", "asking",
    "punctuation", "obfuscated", "obfuscated_hits", "stretched", "single_letters", "log_words",
)


def core(token: str) -> str:
    return token.strip(string.punctuation)


def plain(word: str) -> str:
    """The word with signs for letters read as letters and other signs inside taken out."""
    return word.translate(LETTER_FOR).translate(INNER)


def is_obfuscated(word: str) -> bool:
    """Letters with digits or signs between them, such as st0pid or s.tupid; hyphens and apostrophes are common in words."""
    return not word.isalpha() and word[:1].isalpha() and word[-1:].isalpha() and not word.replace("-", "").replace("'", "").replace("’", "").isalpha()


def terms(text: str) -> set[tuple[int, str]]:
    """(0, word) and (length, beginning) of all words."""
    out: set[tuple[int, str]] = set()
    for t in set(text.lower().split()):
        w = core(t)
        if is_obfuscated(w):
            w = plain(w)
        if w:
            out.add((0, w))
            out.update((n, w[:n]) for n in STEMS if len(w) >= n)
    return out


def term_counts(sample: DataFrame) -> DataFrame:
    """(size, term, counts of clean and toxic documents by fold) from (text, toxic, fold)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in rows.slices(batch.column(0), 4 * rows.SLICE_BYTES):
                counts: dict[tuple[int, str], list[int]] = defaultdict(lambda: [0] * (2 * FOLDS))
                part = [c.slice(s.first, s.last - s.first).to_pylist() for c in batch.columns]
                for text, toxic, fold in zip(*part):
                    for term in terms(text or ""):
                        counts[term][2 * fold + toxic] += 1
                size, name = zip(*counts) if counts else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(size, pa.int32()), pa.array(name, pa.string()), *[pa.array([c[k] for c in counts.values()], pa.int64()) for k in range(2 * FOLDS)]], ["size", "term", *[f"c{k}" for k in range(2 * FOLDS)]])

    columns = ", ".join(f"c{k} bigint" for k in range(2 * FOLDS))
    found = sample.select("text", "toxic", "fold").mapInArrow(run, f"size int, term string, {columns}")
    return found.groupBy("size", "term").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(2 * FOLDS)])


def odds_bound(toxic: np.ndarray, clean: np.ndarray, all_toxic: float, all_clean: float) -> np.ndarray:
    odds = np.log((toxic + 0.5) / (all_toxic + 1.0)) - np.log((clean + 0.5) / (all_clean + 1.0))
    bound = odds - ERRORS * np.sqrt(1.0 / (toxic + 0.5) + 1.0 / (clean + 0.5))
    return np.where(bound >= LEAST_ODDS, bound, 0.0)


#: Term to weights: over all folds first, then with one fold left out after the other.
Lexicon = dict[tuple[int, str], tuple[float, ...]]


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The terms that toxic documents of the sample hold surely more often; the surest ones if there are too many."""
    totals = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    all_counts = np.array([[totals.get((f, y), 0) for y in (0, 1)] for f in range(FOLDS)], float)
    clean, toxic = (sum(F.col(f"c{2 * f + y}") for f in range(FOLDS)) for y in (0, 1))
    share = float((all_counts[:, 1].sum() + 1) / (all_counts[:, 0].sum() + 1))
    odds = F.log((toxic + 0.5) / (clean + 0.5)) - math.log(share)
    bound = odds - ERRORS * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    kept = term_counts(sample).where(toxic >= 3).withColumn("bound", bound).where(F.col("bound") >= LEAST_ODDS)
    table = kept.orderBy(F.desc("bound"), "size", "term").limit(LEXICON_TERMS).toPandas()
    out: Lexicon = {}
    if len(table):
        counts = table[[f"c{k}" for k in range(2 * FOLDS)]].to_numpy(float).reshape(len(table), FOLDS, 2)
        weights = []
        for left in (None, *range(FOLDS)):
            used = [f for f in range(FOLDS) if f != left]
            weights.append(odds_bound(counts[:, used, 1].sum(1), counts[:, used, 0].sum(1), all_counts[used, 1].sum(), all_counts[used, 0].sum()))
        for size, term, w in zip(table["size"], table["term"], np.stack(weights, 1)):
            out[int(size), term] = tuple(w.tolist())
    return out


class Reader:
    """Features of whole texts under a lexicon; what is known of a token is kept for a bounded number of tokens."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.seen: dict[tuple[int, str], tuple] = {}

    def token(self, t: str, column: int) -> tuple:
        """(weight as a word, weight by its beginning, second person, obfuscated, stretched, one letter)."""
        known = self.seen.get((column, t))
        if known is None:
            w = core(t)
            hidden = is_obfuscated(w)
            v = plain(w) if hidden else w
            word = self.lexicon.get((0, v))
            stem = max((self.lexicon[n, v[:n]][column] for n in STEMS if (n, v[:n]) in self.lexicon and len(v) >= n), default=0.0)
            stretched = len(v) > 3 and any(a == b == c for a, b, c in zip(v, v[1:], v[2:]))
            known = (word[column] if word else 0.0, stem, w in SECOND_PERSON, hidden, stretched, len(w) == 1 and w.isalpha())
            if not any(known):
                known = ()
            if len(self.seen) >= MEMO:
                self.seen.clear()
            self.seen[column, t] = known
        return known

    def features(self, text: str | None, column: int = 0) -> list[float]:
        text = text or ""
        tokens = text.lower().split()
        n = max(1, len(tokens))
        marked = {t: k for t in set(tokens) if (k := self.token(t, column))}
        places = [(i, marked[t]) for i, t in enumerate(tokens) if t in marked] if marked else []
        words = [k[0] for _, k in places if k[0]]
        stems = [k[1] for _, k in places if k[1]]
        you = np.array([i for i, k in places if k[2]])
        hits = np.array([i for i, k in places if k[0] or k[1]])
        closeness = 1.0 / (1.0 + nearest(hits, you)) if len(hits) and len(you) else np.zeros(1)
        chars = max(1, len(text))
        raw = text.encode("utf-8", "replace")
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
        return [
            len(words) / n, sum(words) / n, max(words, default=0.0), math.log1p(sum(1 for k in marked.values() if k[0])),
            len(stems) / n, sum(stems) / n, max(stems, default=0.0), math.log1p(sum(1 for k in marked.values() if k[1])),
            float(closeness.sum()) / n, float(closeness.max()), len(you) / n,
            upper / max(1, upper + lower), sum(map(str.isupper, text.split())) / n, float(counts[33]) / chars, float(counts[63]) / chars,
            float(counts[PUNCTUATION].sum()) / chars, sum(k[3] for _, k in places) / n, sum(1 for _, k in places if k[3] and (k[0] or k[1])) / n,
            sum(k[4] for _, k in places) / n, sum(k[5] for _, k in places) / n, math.log1p(len(tokens)),
        ]


PUNCTUATION = np.array([ord(c) for c in string.punctuation])


def nearest(hits: np.ndarray, others: np.ndarray) -> np.ndarray:
    at = np.searchsorted(others, hits)
    left = np.abs(hits - others[np.maximum(at - 1, 0)])
    return np.minimum(left, np.abs(hits - others[np.minimum(at, len(others) - 1)]))


def with_features(df: DataFrame, lexicon: Lexicon, text: str, keep: list[str], fold: str | None = None) -> DataFrame:
    """The columns `keep` and an array of features; rows of a fold are read with the lexicon of the other folds."""
    source = df.select(*keep, F.col(text).alias("__text"), (F.col(fold) + 1 if fold else F.lit(0)).cast("int").alias("__column"))
    sent = df.sparkSession.sparkContext.broadcast(lexicon)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for batch in batches:
            for s in rows.slices(batch.column(len(keep)), 4 * rows.SLICE_BYTES):
                part = [c.slice(s.first, s.last - s.first) for c in batch.columns]
                found = [reader.features(t, c) for t, c in zip(part[-2].to_pylist(), part[-1].to_pylist())]
                yield pa.RecordBatch.from_arrays([*part[: len(keep)], pa.array(found, pa.list_(pa.float64()))], [*keep, "features"])

    return source.mapInArrow(run, f"{fields}, features array<double>")


@dataclass
class Model:
    """Without both labels to learn from, there are no trees and every score is `rate`."""

    lexicon: Lexicon
    rate: float
    trees: GBTClassificationModel | None = None
    curve: IsotonicRegressionModel | None = None


def fit(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> Model:
    """Learn from documents whose id has a label (0 or 1) and meets `learn`.

    About `sample_rows` labelled rows are drawn by a hash of the id; their
    ids, a bounded number, are sent to the documents.  The lexicon comes from
    this sample.  Trees are trained on three of four folds, whose features
    come from the lexicon of the other folds; the fourth fold calibrates.
    Ids with several labels, and rows without an id, teach nothing; of
    several rows with one id the least text teaches, so the bound holds.
    """
    named = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("toxic")).where("__id is not null and toxic in (0, 1)")
    named = named.groupBy("__id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").select("__id", "toxic")
    named = named.where(learn(F.col("__id")))
    n = named.count()
    drawn = named.where(F.pmod(F.xxhash64(F.lit(seed), "__id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_rows / max(1, n))))
    drawn = drawn.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed + 1), "__id"), F.lit(FOLDS)).cast("int"))
    met = docs.select(F.col(id_col).alias("__doc"), F.col(text).alias("text")).join(F.broadcast(drawn), F.col("__doc") == F.col("__id"))
    sample = cut_lineage(met.groupBy("__id", "toxic", "fold").agg(F.min("text").alias("text")).select("text", "toxic", "fold"))
    sizes = {r[0]: r[1] for r in sample.where(f"fold <> {FOLDS - 1}").groupBy("toxic").count().collect()}
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model({}, rate)
    lexicon = learn_lexicon(sample)
    known = cut_lineage(with_features(sample, lexicon, "text", ["toxic", "fold"], "fold")).select(F.col("toxic").cast("double").alias("toxic"), "fold", array_to_vector("features").alias("features"))
    trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=seed).fit(known.where(f"fold <> {FOLDS - 1}").select("toxic", "features"))
    rest = trees.transform(known.where(f"fold = {FOLDS - 1}")).select("toxic", vector_to_array("probability")[1].alias("p"))
    rest = rest if not rest.isEmpty() else trees.transform(known).select("toxic", vector_to_array("probability")[1].alias("p"))
    curve = IsotonicRegression(featuresCol="p", labelCol="toxic").fit(rest)
    return Model(lexicon, rate, trees, curve)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., score): 0 to 1 for every row, NULL and empty texts too.  Only the text is an input."""
    columns = [id_col, *keep]
    if model.trees is None:
        return docs.select(*columns, F.lit(float(model.rate)).alias("score"))
    read = with_features(docs, model.lexicon, text, columns).withColumn("features", array_to_vector("features"))
    raw = model.trees.transform(read).select(*columns, vector_to_array("probability")[1].alias("p"))
    lifted = model.curve.transform(raw)
    value = (1 - SMOOTH) * F.col("prediction") + SMOOTH * F.col("p")
    return lifted.select(*columns, F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)).alias("score"))
