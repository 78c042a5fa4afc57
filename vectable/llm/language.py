"""Language identification with error-correcting output codes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectable.llm import rows

UNKNOWN = "und"
BUCKETS = 1 << 12
GRAMS = (1, 2, 3)
SAMPLE_PER_LANGUAGE, SAMPLE_ROWS, SAMPLE_BYTES = 1500, 12_000, 64 << 20
#: Texts whose two nearest codewords lie within this share of the larger loss are ambiguous.
AMBIGUITY = 0.01
EXHAUSTIVE_UPTO = 7
LETTER = r"\p{L}"
WORD = re.compile(r"[^\W\d_]+")


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """One row of +1/-1 bits per language, rows far apart, no constant column.

    Up to seven languages get every different way of parting them in two;
    more get the best of 50 random matrices with 10 log2(n) columns.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE_UPTO:
        ways = np.arange(1, 1 << (n - 1))
        bits = (ways[None, :] >> np.arange(n)[::-1][:, None]) & 1
        return np.where(bits == 1, -1.0, 1.0)
    rng = np.random.default_rng(seed)
    best, apart = np.empty((n, 0)), -1
    for _ in range(50):
        m = rng.choice((-1.0, 1.0), (n, int(np.ceil(10 * np.log2(n)))))
        m = m[:, np.abs(m.sum(0)) < n]
        least = min(int((m[i] != m[j]).sum()) for i in range(n) for j in range(i))
        if least > apart:
            best, apart = m, least
    return best


def letters_only(text: str | None) -> bytes:
    """Lower-cased words of letters, one space around each; empty without a letter."""
    if not text:
        return b""
    words = " ".join(WORD.findall(text.lower()))
    return f" {words} ".encode("utf-8", "replace") if any(map(str.isalpha, words)) else b""


def gram_counts(texts: list[bytes]) -> np.ndarray:
    """Hashed counts of 1 to 3 byte grams, a row per text, damped and of unit length."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, t in enumerate(texts):
        b = np.frombuffer(t, np.uint8).astype(np.uint32)
        for n in GRAMS:
            if len(b) < n:
                continue
            h = np.full(len(b) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h * np.uint32(0x01000193)) ^ b[k : len(b) - n + 1 + k]
            h *= np.uint32(0x9E3779B1)
            out[i] += np.bincount(h >> np.uint32(20), minlength=BUCKETS)
    np.log1p(out, out=out)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-12)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def train_bits(x: np.ndarray, y: np.ndarray, codes: np.ndarray, passes: int = 80, rate: float = 20.0, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic weights for every bit by accelerated gradient steps; languages weigh alike."""
    target = codes[y].astype(x.dtype)
    share = (1.0 / (np.bincount(y, minlength=len(codes))[y] * len(codes))).astype(x.dtype)
    w, b = np.zeros((x.shape[1], codes.shape[1]), x.dtype), np.zeros(codes.shape[1], x.dtype)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(passes):
        margin = x @ (w + 0.9 * vw) + (b + 0.9 * vb)
        g = -target / (1.0 + np.exp(np.clip(target * margin, -30, 30))) * share[:, None]
        vw = 0.9 * vw - rate * (x.T @ g + decay * w)
        vb = 0.9 * vb - rate * 0.1 * g.sum(0)
        w, b = w + vw, b + vb
    return w, b


def fit(df: DataFrame, text: str, label: str, learn: Column, per_language: int = SAMPLE_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn from rows with `learn` true and a label.

    At most `per_language` different texts of each language, `sample_rows` of
    all, and `sample_bytes` bytes are learned from: those with the lowest
    hashes, so that copies count once and a text that many rows hold weighs no
    more than another.  Texts over an eighth of a language's bytes come last, and one text is
    taken in any case.  Rows with a label but no letter teach nothing.
    """
    known = df.where(learn & F.col(label).isNotNull() & F.col(text).rlike(LETTER)).select(F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((BUCKETS, 1)), np.zeros(1))
    per_language, most = min(per_language, max(1, sample_rows // len(languages))), sample_bytes // len(languages)
    # Twice the share that gives this number, so that the lowest hashes are among those drawn.
    share = F.element_at(F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, 2.0 * per_language / sizes[k]))]), F.col("label"))
    drawn = known.where(F.pmod("h", F.lit(1 << 30)) <= share * float(1 << 30)).groupBy("label", "h").agg(F.max(F.octet_length("text")).alias("size"))
    order = W.partitionBy("label").orderBy(F.col("size") * 8 > most, F.pmod("h", F.lit(1 << 30)), "h")
    placed = drawn.select("label", "h", F.row_number().over(order).alias("place"), F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("bytes"))
    chosen = placed.where((F.col("place") == 1) | ((F.col("place") <= per_language) & (F.col("bytes") <= most))).select("label", "h")
    picked = known.join(F.broadcast(chosen), ["label", "h"]).groupBy("label", "h").agg(F.min("text").alias("text"))
    sample = picked.select(F.col("label").alias(label), F.col("text").alias(text)).toPandas().sort_values([label, text], kind="stable")
    y = np.searchsorted(languages, sample[label].to_numpy().astype(object)) if len(languages) > 1 else np.zeros(len(sample), int)
    codes = codewords(len(languages))
    w, b = train_bits(gram_counts([letters_only(t) for t in sample[text]]), y, codes)
    return Model(languages, codes, w, b)


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword under the logistic loss of every bit, weighted by the bit's own certainty; its share; ambiguity."""
    sure = np.abs(np.tanh(margins / 2.0)) + 1e-3
    loss = np.stack([(sure * np.logaddexp(0.0, -margins * c)).sum(1) for c in model.codes], 1)
    best = loss.argmin(1)
    p = np.exp(loss.min(1, keepdims=True) - loss)
    score = p[np.arange(len(p)), best] / p.sum(1)
    two = np.partition(loss, 1, 1)[:, :2] if loss.shape[1] > 1 else np.column_stack([loss[:, 0], loss[:, 0] + 1.0])
    return best, score, (two[:, 1] - two[:, 0]) <= AMBIGUITY * two[:, 1]


def identify(df: DataFrame, model: Model, text: str = "text", prediction: str = "lang_pred", score: str = "score", ambiguous: str = "ambiguous") -> DataFrame:
    """Adds the predicted language, its score from 0 to 1, and whether a second language is as near.

    NULL texts and texts without a letter are predicted `und` with score 0 and
    are not ambiguous; so is every text if no language was learned.  Columns
    of `df` with the same names are replaced.  Whole texts are read.
    """
    keep = [c for c in df.columns if c not in (prediction, score, ambiguous)]
    source = df.select(*keep)
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, doubts = [], [], []
            for s in rows.slices(batch.column(at)):
                texts = [letters_only(t) for t in batch.column(at).slice(s.first, s.last - s.first).to_pylist()]
                for lo in range(0, len(texts), 1024):
                    part = texts[lo : lo + 1024]
                    has = np.array([len(t) > 2 for t in part]) & bool(model.languages)
                    best, sc, doubt = decode(model, gram_counts(part) @ model.weights + model.bias) if model.languages else (np.zeros(len(part), int), np.zeros(len(part)), np.zeros(len(part), bool))
                    names += [model.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
                    scores += np.where(has, sc, 0.0).tolist()
                    doubts += (doubt & has).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubts, pa.bool_())], [*batch.schema.names, prediction, score, ambiguous])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, f"{fields}, `{prediction}` string, `{score}` double, `{ambiguous}` boolean")
