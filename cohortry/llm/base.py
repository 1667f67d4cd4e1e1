"""What the corpus operators share: words of an Arrow text column as arrays, sampling of labelled rows, scratch tables.

A word is a maximal run of bytes other than space and ``\\t``-``\\r``; because all of those are ASCII, words are
found on the UTF-8 bytes. Every function here treats a null text as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 500
"""Texts handed to a Python worker at once; bounds its memory."""
HASH_BYTES = 1 << 20
"""Text hashed at once: the work arrays are eight times as large."""

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def shielded(documents: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``documents`` with all columns but the ``used`` ones renamed out of the way of an operator's own, and the way back."""
    names = {c: f"_own_{k}" for k, c in enumerate(documents.columns) if c not in used}
    return documents.withColumnsRenamed(names), lambda df: df.withColumnsRenamed({own: c for c, own in names.items()})


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep the Arrow batches of text small, whatever the session says."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` applied to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield work(batch)

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Texts:
    """The texts of one batch as one byte buffer, with a space before, between and after them.

    ``bytes``: the buffer, every white-space byte kept as it is. ``starts``/``ends``: byte range of each text.
    ``word_start``/``word_end``: byte range of each word; ``word_offsets``: first word of each text, and the total.
    """

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "") if column.null_count else column
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary())
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        data = column.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.n = n
        self.bytes = np.insert(raw, offsets, np.uint8(32))
        self.starts = offsets[:-1] + np.arange(1, n + 1)
        self.ends = offsets[1:] + np.arange(1, n + 1)
        self.space = _SPACE[self.bytes]
        edge = np.diff(self.space.astype(np.int8))
        self.word_start = np.flatnonzero(edge == -1) + 1
        self.word_end = np.flatnonzero(edge == 1) + 1
        self.word_offsets = np.concatenate((np.searchsorted(self.word_start, self.starts), [len(self.word_start)])).astype(np.int64)

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[self.ends] - total[self.starts]

    def per_text_of_words(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.word_offsets[1:]] - total[self.word_offsets[:-1]]

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_offsets)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def word_hash(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes: a polynomial over them, scrambled."""
        base = pow(0x9E3779B97F4A7C15 + 2 * seed, 1, 1 << 64) | 1
        inverse = pow(base, -1, 1 << 64)
        value = np.empty(len(self.word_start), dtype=np.uint64)
        low = 0
        while low < len(value):  # words of about HASH_BYTES at a time
            begin = self.word_start[low]
            high = max(low + 1, int(np.searchsorted(self.word_end, begin + HASH_BYTES, side="right")))
            part = self.bytes[begin : self.word_end[high - 1]].astype(np.uint64)
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            part += np.uint64(1)
            part *= _powers(base, len(part))
            np.cumsum(part, out=total[1:])
            start, end = self.word_start[low:high] - begin, self.word_end[low:high] - begin
            value[low:high] = (total[end] - total[start]) * _powers(inverse, len(part))[start]
            low = high
        return mix64(value + np.uint64(seed))

    def window_hash(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every run of ``width`` words that stays in one text, and the first word of each."""
        if len(words) < width:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            value *= np.uint64(0x9E3779B97F4A7C15)
            value += words[k : len(words) - width + 1 + k]
        text = self.text_of_word()
        first = np.flatnonzero(text[: len(value)] == text[width - 1 :])
        return mix64(value[first]), first

    def words(self, i: int) -> list[bytes]:
        """The words of one text."""
        return self.text(i).split()

    def text(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, 1 << 16), np.uint64(base), dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= 1 << 22:  # keep tables of usual batches only
            _POWERS[base] = known
    return known[:size]


def spread(first: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of ``width`` words that starts at one of ``first``."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + width, -1)
    return np.cumsum(change[:-1]) > 0


def distinct_grams(texts: Texts, spans: tuple[int, ...], size: int, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of a batch: the number of each word; bucket (of ``size``, a power of two) and word number of
    every character n-gram of a distinct word between spaces; the n-grams of each distinct word."""
    _, first, number = np.unique(texts.word_hash(), return_index=True, return_inverse=True)
    start, length = texts.word_start[first], texts.word_end[first] - texts.word_start[first]
    # The distinct words side by side, a space before each and one at the end.
    begin = np.cumsum(length + 1) - length
    plain = np.full(int(length.sum()) + len(first) + 1, 32, dtype=np.uint8)
    owner = np.repeat(np.arange(len(first)), length)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    inner = texts.bytes[start[owner] + inside]
    plain[begin[owner] + inside] = _LOWER[inner] if lower else inner
    del owner, inside, inner
    space = plain == 32
    at = np.cumsum(space, dtype=np.int32) - 1
    wide = plain.astype(np.uint64)
    buckets, words = [], []
    for span in spans:
        count = len(plain) - span + 1
        if count <= 0:
            continue
        value = np.zeros(count, dtype=np.uint64)
        inner = np.zeros(count, dtype=bool)
        for k in range(span):
            value *= np.uint64(257)
            value += wide[k : count + k]
            if 0 < k < span - 1:
                inner |= space[k : count + k]
        here = np.flatnonzero(~inner)
        buckets.append((mix64(value[here] + np.uint64(span)) & np.uint64(size - 1)).astype(np.int32))
        words.append(at[here].astype(np.int32))
    bucket = np.concatenate(buckets) if buckets else np.zeros(0, np.int32)
    word = np.concatenate(words) if words else np.zeros(0, np.int32)
    return number, bucket, word, np.maximum(np.bincount(word, minlength=len(first)), 1)


def repeated_words(texts: Texts, words: np.ndarray, width: int = 5) -> np.ndarray:
    """Per text, the words that lie in a ``width``-word window found twice or more in that text."""
    value, first = texts.window_hash(words, width)
    if not len(value):
        return np.zeros(texts.n, dtype=np.int64)
    # The text's number is mixed in, so equal windows of different texts stay apart.
    keyed = value ^ mix64(texts.text_of_word()[first].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keyed, kind="stable")
    same = keyed[order][1:] == keyed[order][:-1]
    twice = np.zeros(len(keyed), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return texts.per_text_of_words(spread(first[twice], width, len(words)).astype(np.int64))


def repeated_lines(texts: Texts) -> np.ndarray:
    """Per text, the ``\\n``-separated lines with a word that equal an earlier line."""
    found = np.zeros(texts.n, dtype=np.int64)
    for i in range(texts.n):
        lines = [x for x in texts.text(i).split(b"\n") if x.strip()]
        found[i] = len(lines) - len(set(lines))
    return found


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the rows that no label is learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_ids(labels: DataFrame, column: str, per_class: int, seed: int = 11) -> DataFrame:
    """At most ``per_class`` rows of each label, the smallest hashes, none of them held out: (doc_id, label).

    A row with a null id or label takes no part; repeated ids count once per label.
    """
    usable = labels.select("doc_id", F.col(column).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out()
    )
    usable = usable.distinct().withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    picked = [usable.where(F.col("label") == k).orderBy("draw", "doc_id").limit(per_class) for k in (0, 1)]
    return picked[0].unionByName(picked[1]).select("doc_id", "label")


def class_shares(labels: DataFrame, column: str) -> tuple[int, int]:
    """How many labelled rows, held-out ones aside, carry 0 and 1."""
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out())
    row = usable.select(*(F.sum((F.col(column) == k).cast("long")).alias(f"n{k}") for k in (0, 1))).first()
    return int(row["n0"] or 0), int(row["n1"] or 0)


def labelled_texts(
    documents: DataFrame, labels: DataFrame, column: str, per_class: int, max_chars: int
) -> tuple[pa.Array, np.ndarray]:
    """A bounded sample of labelled texts on the driver: at most ``2 * per_class`` texts of at most ``max_chars``.

    The picked ids are a table of bounded size, so the broadcast that finds their texts is bounded too. An id on several rows
    gives its smallest text.
    """
    ids = labelled_ids(labels, column, per_class)
    rows = ids.collect()
    if not rows:
        return pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
    spark = documents.sparkSession
    picked = spark.createDataFrame([(r["doc_id"], r["label"]) for r in rows], "doc_id long, label int")
    found = (
        documents.select("doc_id", "text")
        .where(F.length("text") <= max_chars)
        .join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    found.sort(key=lambda r: (r["doc_id"], r["label"], r["text"]))
    return pa.array([r["text"] for r in found], pa.string()), np.array([r["label"] for r in found], dtype=np.int64)


def calibrate(logit: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Platt scaling: slope and intercept that make ``slope * logit + intercept`` a log-odds (weighted Newton steps)."""
    slope, intercept = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(slope * logit + intercept)
        g, h = weight * (p - label), weight * p * (1 - p) + 1e-9
        ga, gb = float(g @ logit) + 1e-3 * (slope - 1), float(g.sum()) + 1e-3 * intercept
        haa, hab, hbb = float(h @ logit**2) + 1e-3, float(h @ logit), float(h.sum()) + 1e-3
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        slope, intercept = slope - np.clip(da, -1, 1), intercept - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-9:
            break
    return float(max(slope, 1e-3)), float(intercept)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
