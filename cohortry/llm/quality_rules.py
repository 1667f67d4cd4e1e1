"""Quality rules: counted base rules, and a calibrated n-gram logistic regression held against a fixed threshold.

The regression reads three hashed averages of a whole text: its words, its word pairs and the character n-grams (3 and 4
bytes) of its words. It is trained on a bounded sample of labelled quality rows, calibrated on rows of the sample that
the fit does not see, and applied in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.base import (
    Texts,
    calibrate,
    class_shares,
    distinct_grams,
    documents_of,
    labelled_texts,
    labels_of,
    map_batches,
    mix64,
    repeated_lines,
    repeated_words,
    sigmoid,
    small_batches,
)

BUCKETS, SPANS = 1 << 18, (3, 4)
PER_CLASS = 1_500
"""Labelled texts of each class the regression is fitted on, at most; longer texts than ``MAX_CHARS`` are not sampled."""
MAX_CHARS = 20_000
EPOCHS, RATE, DECAY, SCALE = 80, 0.05, 0.002, 20.0
THRESHOLD = 0.5
"""Calibrated probability of label 1 from which a document is kept."""
MIN_WORDS, MAX_REPEATED = 10, 20

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(texts: Texts, hashes: np.ndarray) -> dict[str, np.ndarray]:
    return {
        "n_words": texts.n_words,
        # A code point is a byte that does not continue another.
        "word_chars": texts.per_text(~texts.space & ((texts.bytes & 0xC0) != 0x80)),
        "n_symbols": texts.per_text(_SYMBOL[texts.bytes]),
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": repeated_words(texts, hashes),
    }


class Features:
    """The three averages of each text, as weighted buckets that are shared between equal words of a batch."""

    def __init__(self, texts: Texts, hashes: np.ndarray):
        self.n, self.text = texts.n, texts.text_of_word()
        self.words = np.maximum(texts.n_words, 1)
        self.number, self.gram, self.word, self.many = distinct_grams(texts, SPANS, BUCKETS, lower=False)
        mask = np.uint64(BUCKETS - 1)
        self.single = (mix64(hashes + np.uint64(1)) & mask).astype(np.int64)
        together = np.flatnonzero(self.text[1:] == self.text[:-1])
        self.pair = (mix64(hashes[together] * np.uint64(31) + hashes[together + 1]) & mask).astype(np.int64)
        self.pair_text = self.text[together]

    def product(self, weight: np.ndarray) -> np.ndarray:
        """Weights (words, pairs, n-grams by bucket) times features."""
        singles, pairs, grams = weight
        inner = np.bincount(self.word, grams[self.gram], len(self.many)) / self.many
        total = np.bincount(self.text, singles[self.single] + inner[self.number], self.n)
        return SCALE * (total + np.bincount(self.pair_text, pairs[self.pair], self.n)) / self.words

    def transposed(self, error: np.ndarray) -> np.ndarray:
        share = SCALE * error / self.words
        singles = np.bincount(self.single, share[self.text], BUCKETS)
        pairs = np.bincount(self.pair, share[self.pair_text], BUCKETS)
        inner = np.bincount(self.number, share[self.text], len(self.many)) / self.many
        return np.stack((singles, pairs, np.bincount(self.gram, inner[self.word], BUCKETS)))


class Verdict:
    def __init__(self, weight: np.ndarray, bias: float, slope: float = 1.0, intercept: float = 0.0):
        self.weight, self.bias, self.slope, self.intercept = weight.astype(np.float32), bias, slope, intercept

    def margin(self, texts: Texts, hashes: np.ndarray) -> np.ndarray:
        return Features(texts, hashes).product(self.weight) + self.bias

    def probability(self, texts: Texts, hashes: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(texts, hashes) + self.intercept)


def train(texts: Texts, label: np.ndarray) -> Verdict:
    """Logistic regression by Adam on the class-balanced loss, with decaying weights."""
    weight, bias = np.zeros((3, BUCKETS)), 0.0
    if len(np.unique(label)) < 2:
        return Verdict(weight, bias)
    features = Features(texts, texts.word_hash())
    balance = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    m, v, floor = np.zeros_like(weight), np.zeros_like(weight), 0.0
    for step in range(1, EPOCHS + 1):
        error = balance * (sigmoid(features.product(weight) + bias) - label)
        grad = features.transposed(error)
        # Buckets met seldom have small gradients; a floor under Adam's divisor keeps their steps small as well.
        floor = floor or 0.05 * float(np.abs(grad).max()) + 1e-12
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        weight *= 1 - DECAY
        weight -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + floor)
        bias -= 0.5 * float(error.sum())
    return Verdict(weight, bias)


def fit(column: pa.Array, label: np.ndarray, share0: int, share1: int) -> Verdict:
    """Train on four fifths of the sample, calibrate on the rest with the classes' shares of all labels."""
    if len(np.unique(label)) < 2:
        # One class or none: every probability is the labelled share, and one half without any label.
        return Verdict(np.zeros((3, BUCKETS)), 0.0, 1.0, float(np.log((share1 + 0.5) / (share0 + 0.5))))
    part = np.arange(len(label)) % 5
    y = label[part == 0].astype(float)
    verdict = train(Texts(column.filter(pa.array(part != 0))), label[part != 0].astype(float))
    if len(np.unique(y)) == 2:
        rest, total = Texts(column.filter(pa.array(part == 0))), max(share0 + share1, 1)
        weight = np.where(y == 1, share1 / total / y.sum(), share0 / total / (1 - y).sum()) * len(y)
        verdict.slope, verdict.intercept = calibrate(verdict.margin(rest, rest.word_hash()), y, weight)
    return verdict


def judge_quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability) of every row.

    Null and empty texts count zeros and fail the base rules; a null id stays null; repeated rows are judged alike;
    labels of unknown documents are ignored; an empty table gives no rows; other columns are not read.
    """
    spark = documents.sparkSession
    small_batches(spark)
    verdict = fit(*labelled_texts(documents, labels, "quality", per_class, MAX_CHARS), *class_shares(labels, "quality"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(batch.column("text"))
        hashes = texts.word_hash()
        counts = base_counts(texts, hashes)
        failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"])
        probability = verdict.probability(texts, hashes)
        columns = [batch.column("doc_id"), *(pa.array(counts[c], pa.int64()) for c in BASE)]
        columns += [pa.array(failed), pa.array(~failed & (probability >= threshold)), pa.array(probability, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *BASE, "base_failed", "kept", "probability"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, probability double"
    return map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, schema)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(documents_of(spark, sf_dir), labels_of(spark, sf_dir))
