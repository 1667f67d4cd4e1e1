"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every whole text are computed once and written. A bounded sample of labelled rows (``PER_CLASS`` of
each label) is binned and boosted in numpy; the trees are complete, flattened into arrays, and every document
walks all of them at once, level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.base import (
    Texts,
    class_shares,
    documents_of,
    held_out,
    labelled_ids,
    labels_of,
    map_batches,
    mix64,
    repeated_lines,
    repeated_words,
    sigmoid,
    small_batches,
)
from cohortry.session import materialize

PER_CLASS = 20_000
"""Labelled rows of each class the trees are fitted on, at most."""
TREES, DEPTH, BINS, RATE, RIDGE = 80, 4, 64, 0.15, 2.0
THRESHOLD = 0.3

STATISTICS = [
    "words", "word_bytes", "upper", "marks", "symbols", "digits", "non_ascii", "stops", "breaks",
    "repeated_lines", "distinct_words", "repeated_words", "short_words", "brackets", "slashes", "joiners",
]


def _table(characters: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(characters)] = True
    return found


_SETS = {
    "marks": _table(b"!?"),
    "symbols": _table(b"#*$%&|<>"),
    "digits": _table(b"0123456789"),
    "non_ascii": _table(bytes(range(128, 256))),
    "stops": _table(b".,;:"),
    "brackets": _table(b"()[]{}"),
    "slashes": _table(b"/\\@"),
    "joiners": _table(b"-_=+~"),
}
_UPPER, _LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    """One number per text and statistic; all shares of an empty text are 0."""
    n_words = texts.n_words.astype(float)
    words, size = np.maximum(n_words, 1), np.maximum(texts.ends - texts.starts, 1).astype(float)
    length = (texts.word_end - texts.word_start).astype(float)
    hashes = texts.word_hash()
    new = np.zeros(len(hashes), dtype=np.int64)
    new[np.unique(hashes ^ mix64(texts.text_of_word().astype(np.uint64) + np.uint64(1)), return_index=True)[1]] = 1
    upper = texts.per_text(_UPPER[texts.bytes]).astype(float)
    found = {
        "words": np.log1p(n_words),
        "word_bytes": texts.per_text_of_words(length) / words,
        "upper": upper / np.maximum(upper + texts.per_text(_LOWER[texts.bytes]), 1),
        "breaks": texts.per_text(texts.bytes == 10) / words,
        "repeated_lines": repeated_lines(texts) / (1 + texts.per_text(texts.bytes == 10)),
        "distinct_words": texts.per_text_of_words(new) / words,
        "repeated_words": repeated_words(texts, hashes) / words,
        "short_words": texts.per_text_of_words(length == 1) / words,
    }
    found |= {name: texts.per_text(table[texts.bytes]) / size for name, table in _SETS.items()}
    return found


@dataclass
class Forest:
    """Complete trees of one depth as arrays; ``feature``/``cut`` by (tree, node), ``leaf`` by (tree, leaf)."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row; all trees are walked together, one level per step."""
        trees = np.arange(len(self.feature))
        total = np.full(len(x), self.start)
        for low in range(0, len(x), 4096):
            part = x[low : low + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(trees)), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.cut[trees, node])
            total[low : low + 4096] += self.leaf[trees, node - (2**DEPTH - 1)].sum(axis=1)
        return total


def fit(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Forest:
    """Boost trees on the weighted logistic loss; without two classes the forest is the (smoothed) share alone."""
    share = (float(weight @ label) + 0.5) / (float(weight.sum()) + 1)
    start = float(np.log(share / (1 - share)))
    nodes, leaves = 2**DEPTH - 1, 2**DEPTH
    if len(np.unique(label)) < 2:
        return Forest(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, leaves)), start)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin = np.full(n, start)
    features, cuts, values = [], [], []
    for _ in range(TREES):
        p = sigmoid(margin)
        g, h = weight * (p - label), weight * p * (1 - p)
        feature, cut = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * width + np.arange(width)) * BINS + binned
            gains = np.full((many, width, BINS), -np.inf)
            gs = np.bincount(slot.ravel(), np.repeat(g, width), many * width * BINS).reshape(many, width, BINS).cumsum(axis=2)
            hs = np.bincount(slot.ravel(), np.repeat(h, width), many * width * BINS).reshape(many, width, BINS).cumsum(axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gains = gs**2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE) - gt**2 / (ht + RIDGE)
            for f, e in enumerate(edges):
                gains[:, f, len(e) :] = -np.inf
            gains[(hs < 1e-3) | (ht - hs < 1e-3)] = -np.inf
            best = gains.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if gains[k, f, b] > 1e-9:
                    feature[first + k], cut[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - nodes
        value = -RATE * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + RIDGE)
        margin += value[at]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Forest(np.array(features), np.array(cuts), np.array(values), start)


def score_quality(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null and empty texts are scored by their (zero) statistics; a null id is not held out; repeated rows are scored
    alike; without usable labels of both classes every score is the labelled share (one half without any label).
    Labels of unknown documents are ignored. Very long texts are described whole, other columns are not read, and an empty table gives no rows.
    """
    spark = documents.sparkSession
    small_batches(spark)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = statistics(Texts(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[c], pa.float64()) for c in STATISTICS)], names=["doc_id", *STATISTICS])

    schema = "doc_id long, " + ", ".join(f"{c} double" for c in STATISTICS)
    described = materialize(map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, schema), "statistics")

    share0, share1 = class_shares(labels, "quality")
    # At most 2 * per_class rows: the broadcast and what comes back are bounded by the sample, an id on several rows counts once.
    sampled = described.join(F.broadcast(labelled_ids(labels, "quality", per_class)), "doc_id").groupBy("doc_id", "label")
    sampled = sampled.agg(F.min(F.struct(*STATISTICS)).alias("smallest")).select("doc_id", "label", "smallest.*")
    rows = sampled.orderBy("doc_id", "label").collect()
    x = np.array([[r[c] for c in STATISTICS] for r in rows]).reshape(len(rows), len(STATISTICS))
    y = np.array([r["label"] for r in rows], dtype=float)
    # The sample holds as many rows of either class; weights bring back the shares of all labelled rows.
    weight = np.where(y == 1, share1 / max(y.sum(), 1), share0 / max((1 - y).sum(), 1)) * len(y) / max(share0 + share1, 1)
    forest = fit(x, y, weight)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS], axis=1)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(forest.margin(values)), pa.float64())], names=["doc_id", "score"])

    scored = map_batches(described, score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents_of(spark, sf_dir), labels_of(spark, sf_dir))
