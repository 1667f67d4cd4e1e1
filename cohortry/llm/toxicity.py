"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is its character n-grams (3 to 5 bytes of the lower-cased word between spaces), each hashed to one of
``BUCKETS`` vectors; a passage, ``PASSAGE`` words in a row from any word on, is the average of its words' averages (a text
shorter than that is one passage, filled up with zero vectors), and a linear softmax over
that average tells toxic from clean. Embeddings and softmax are trained together, so a misspelling never seen takes
the vectors of the n-grams it shares. A document is as toxic as its worst passage; in training the attention to a
document's passages narrows from all of them to the worst.
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
    held_out,
    labelled_texts,
    labels_of,
    map_batches,
    shielded,
    sigmoid,
    small_batches,
)

BUCKETS, SIZE, SPANS = 1 << 18, 8, (3, 4, 5)
PASSAGE = 8
PER_CLASS = 1_500
"""Labelled texts of each class the model is fitted on, at most; longer texts than ``MAX_CHARS`` are not sampled."""
MAX_CHARS = 20_000
EPOCHS, RATES, FLOOR, DECAY, SHARPNESS = 150, (0.2, 0.1, 0.1), 0.03, 0.01, 4.0
THRESHOLD = 0.5


def _grams(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return distinct_grams(texts, SPANS, BUCKETS, lower=True)


def _passages(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and text of every passage; passages do not cross texts."""
    counts = np.maximum(texts.n_words - PASSAGE + 1, np.minimum(texts.n_words, 1))
    owner = np.repeat(np.arange(texts.n), counts)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + texts.word_offsets[owner]
    return first, np.minimum(first + PASSAGE, texts.word_offsets[owner + 1]), owner


def _worst(logit: np.ndarray, owner: np.ndarray, n: int, empty: float) -> np.ndarray:
    found = np.full(n, -np.inf)
    np.maximum.at(found, owner, logit)
    return np.where(np.isinf(found), empty, found)


def _sums(target: np.ndarray, values: np.ndarray, source: np.ndarray, size: int) -> np.ndarray:
    """``values[source]`` added up by ``target``, some n-grams at a time."""
    total = np.zeros(size)
    for low in range(0, len(target), 1 << 20):
        part = slice(low, low + (1 << 20))
        total += np.bincount(target[part], values[source[part]], size)
    return total


class Model:
    """After training only each bucket's logit is left: the softmax is linear in the embeddings."""

    def __init__(self, logit: np.ndarray, bias: float, slope: float = 1.0, intercept: float = 0.0):
        self.logit, self.bias, self.slope, self.intercept = logit.astype(np.float32), bias, slope, intercept

    def margin(self, texts: Texts) -> np.ndarray:
        number, bucket, word, many = _grams(texts)
        value = np.bincount(word, self.logit[bucket], len(many)) / many
        first, end, owner = _passages(texts)
        # Added word by word, so that a score does not depend on the other texts of the batch.
        of_word = np.concatenate((value[number], np.zeros(PASSAGE)))
        total = sum(np.where(first + k < end, of_word[first + k], 0.0) for k in range(PASSAGE))
        return _worst(total / PASSAGE + self.bias, owner, texts.n, self.bias)

    def score(self, texts: Texts) -> np.ndarray:
        return sigmoid(self.slope * self.margin(texts) + self.intercept)


def train(texts: Texts, label: np.ndarray, seed: int = 5) -> Model:
    """Adam on the cross entropy of the softmax, embeddings and softmax weights moving together."""
    rng = np.random.default_rng(seed)
    number, bucket, word, many = _grams(texts)
    first, end, owner = _passages(texts)
    if not len(owner) or len(np.unique(label)) < 2:
        return Model(np.zeros(BUCKETS), 0.0)
    embed = rng.normal(0, 0.1, (BUCKETS, SIZE))
    soft = rng.normal(0, 0.5, (SIZE, 2))
    bias = np.zeros(2)
    toxic = label == 1
    of_clean, clean = ~toxic[owner], int((~toxic).sum())
    state = [np.zeros_like(p) for p in (embed, embed, soft, soft, bias, bias)]
    floor = None
    for step in range(1, EPOCHS + 1):
        way = soft[:, 1] - soft[:, 0]
        value = _sums(word, embed @ way, bucket, len(many)) / many
        total = np.concatenate(([0.0], np.cumsum(value[number])))
        logit = (total[end] - total[first]) / PASSAGE + bias[1] - bias[0]
        p = sigmoid(logit)
        # Attention over a document's passages: even at first, on the worst of them towards the end.
        focus = np.exp(SHARPNESS * step / EPOCHS * (logit - _worst(logit, owner, texts.n, -np.inf)[owner]))
        focus /= np.bincount(owner, focus, texts.n)[owner]
        error = np.where(of_clean, focus * p / clean + p / of_clean.sum(), focus * (p - 1) / toxic.sum())
        # A word takes part in every passage over it.
        change = np.bincount(first, error, len(number) + 1) - np.bincount(end, error, len(number) + 1)
        of_word = np.bincount(number, np.cumsum(change)[:-1] / PASSAGE, len(many))
        pull = _sums(bucket, of_word / many, word, BUCKETS)
        toward = pull @ embed
        # n-grams seen seldom have small gradients; a floor under Adam's divisor keeps their steps small as well.
        floor = floor or FLOOR * float(np.abs(pull).max() * np.abs(way).max())

        def move(value: np.ndarray, m: np.ndarray, v: np.ndarray, grad: np.ndarray, rate: float, least: float) -> None:
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value *= 1 - DECAY
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + least)

        for low in range(0, BUCKETS, 1 << 14):  # some embeddings at a time, so that the work arrays stay small
            rows = slice(low, low + (1 << 14))
            move(embed[rows], state[0][rows], state[1][rows], np.outer(pull[rows], way), RATES[0], floor)
        move(soft, state[2], state[3], np.stack((-toward, toward), axis=1), RATES[1], 1e-8)
        move(bias, state[4], state[5], np.array([-error.sum(), error.sum()]), RATES[2], 1e-8)
    way = soft[:, 1] - soft[:, 0]
    return Model(embed @ way, float(bias[1] - bias[0]))


def fit(column: pa.Array, label: np.ndarray, share0: int, share1: int) -> Model:
    """Train on four fifths of the sample and calibrate on the rest, weighted to the classes' shares of all labels."""
    part = np.arange(len(label)) % 5
    texts = Texts(column.filter(pa.array(part != 0)))
    model = train(texts, label[part != 0])
    rest, y = Texts(column.filter(pa.array(part == 0))), label[part == 0]
    total = max(share0 + share1, 1)
    if len(np.unique(y)) < 2:
        odds = np.log((share1 + 0.5) / (share0 + 0.5))
        return Model(model.logit, model.bias, 1.0 if len(np.unique(label)) == 2 else 1e-3, float(odds) if len(np.unique(label)) < 2 else 0.0)
    weight = np.where(y == 1, share1 / total / max((y == 1).sum(), 1), share0 / total / max((y == 0).sum(), 1)) * len(y)
    model.slope, model.intercept = calibrate(model.margin(rest), y.astype(float), weight)
    return model


def score_toxicity(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Every row of ``documents`` with all its columns, and ``toxic_score`` (0 to 1) after them.

    Null and empty texts get the score of no evidence; repeated rows score alike; without labels of both classes
    every score is about the labelled share (one half without any label); labels of unknown documents are ignored.
    A column of that name in the input is replaced.
    Very long texts are scored whole, they only take no part in the fit; an empty table gives no rows.
    """
    spark = documents.sparkSession
    small_batches(spark)
    column, label = labelled_texts(documents, labels, "toxic", per_class, MAX_CHARS)
    model = fit(column, label, *class_shares(labels, "toxic"))

    documents = documents.drop("toxic_score")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.score(Texts(batch.column("text")))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "toxic_score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*documents.schema.fields, StructField("toxic_score", DoubleType())])
    return map_batches(documents, work, schema)


def keep_civil(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that are not toxic, with their own columns, whatever their names.

    Without labels of both classes nothing can be told apart, and every row stays.
    """
    if not all(class_shares(labels, "toxic")):
        return documents
    inner, restored = shielded(documents, "doc_id", "text")
    scored = score_toxicity(inner, labels)
    return restored(scored.where(F.col("toxic_score") < threshold).drop("toxic_score"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = documents_of(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_toxicity(documents, labels_of(spark, sf_dir)).drop("text")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"))
