"""Substring dedup by recompression.

Rounds rename the word sequence of every text: first runs of one word become one symbol, then in every round adjacent symbols
are paired wherever a hash of the left one says "left" and of the right one "right". Names are hashes of what they stand
for, hence the same everywhere without a dictionary. Along with every symbol goes its context, the range of words
that fixed it; wherever those words stand, the same symbol stands at the same place in them. So two equal windows hold the
same symbols whose context lies inside the window; of the highest ones among them the one with the smallest scrambled name,
the window's anchor, is the same in both, and neighbouring windows mostly share theirs.

1. the anchors of all windows are named by symbol and context; names that occur twice reveal where repeats can be;
2. only the windows with such an anchor are hashed and grouped under it: within a group, all but the earliest are repeats;
3. each document drops the words its repeated windows cover.

Names met more than ``HOT`` times are grouped with partial sums before the shuffle and joined back, which Spark can split;
all others are compared inside their partition.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.base import Texts, documents_of, map_batches, mix64, small_batches
from cohortry.session import materialize

WIDTH, ROUNDS = 20, 3
HOT = 100_000
"""Occurrences of a name that one task still compares: about a million windows, some 50 MB."""
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def parse(texts: Texts, words: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per round the symbols in order as (name, context start, context end), in words of the whole batch."""
    name, left, text = words.copy(), np.arange(len(words)), texts.text_of_word()
    right = left + 1
    levels = [(name, left, right)]
    for turn in range(rounds):
        if len(name) < 2:
            break
        beside = text[1:] == text[:-1]
        if turn == 0:
            # Runs: a symbol is known not to go on once the next word on either side is known. At the end of a text there
            # is none; the context then reaches over it, so that no window holds a symbol fixed by the end.
            same = beside & (name[1:] == name[:-1])
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            last = np.append(first[1:], len(name)) - 1
            many = last - first + 1
            name = np.where(many > 1, mix64(name[first] * np.uint64(31) + many.astype(np.uint64)), name[first])
            left, right, text = left[first], right[last], text[first]
            left, right = left - 1, right + 1
            beside = text[1:] == text[:-1]
        side = (mix64(name + np.uint64(turn * 2 + 1)) & np.uint64(1)).astype(bool)
        joined = beside & ~side[:-1] & side[1:]
        # An unpaired "left" depends on its right neighbour, an unpaired "right" on its left one.
        # (At the ends of a text contexts reach over it already.)
        new_left, new_right = left.copy(), right.copy()
        alone_right = beside & side[1:] & ~joined
        alone_left = beside & ~side[:-1] & ~joined
        new_left[1:][alone_right] = left[:-1][alone_right]
        new_right[:-1][alone_left] = right[1:][alone_left]
        head = np.concatenate(([True], ~joined))
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(name)) - 1
        pair = last > first
        name = np.where(pair, mix64(name[first] * np.uint64(_BASE) + name[last] + np.uint64(turn)), name[first])
        left, right, text = new_left[first], new_right[last], text[first]
        levels.append((name, left, right))
    return levels


class Windows:
    """All windows of a batch: first word, hash, and the anchor's name, context start and context end."""

    def __init__(self, texts: Texts, width: int = WIDTH):
        words = texts.word_hash()
        text = texts.text_of_word()
        size = len(words)
        power, back = _geometric(_BASE, size + 1), _geometric(_INVERSE, size + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((words | np.uint64(1)) * power[:size], dtype=np.uint64)))

        def span(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return mix64((total[high] - total[low]) * back[low] + (high - low).astype(np.uint64))

        self.first = np.flatnonzero(text[: max(size - width + 1, 0)] == text[width - 1 :]) if size >= width else np.zeros(0, np.int64)
        self.text = text[self.first]
        self.begin = texts.word_offsets[self.text]
        self.name = np.zeros(len(self.first), np.uint64)
        self.low, self.high = np.zeros(len(self.first), np.int64), np.zeros(len(self.first), np.int64)
        open_ = np.arange(len(self.first))
        for name, left, right in reversed(parse(texts, words)):
            if not len(open_):
                break
            # The symbols whose context lies inside the window follow one another, as contexts move to the right.
            start = np.concatenate(([0], np.cumsum(np.bincount(left + 1, minlength=size + 2))))[self.first[open_] + 1]
            end = np.cumsum(np.bincount(right, minlength=size + 2))[self.first[open_] + width]
            inside = end > start
            at = _smallest(name, start[inside], end[inside])
            rows = open_[inside]
            self.name[rows] = mix64(name[at] ^ span(left[at], right[at]))
            self.low[rows], self.high[rows] = left[at], right[at]
            open_ = open_[~inside]
        self.hash = span(self.first, self.first + width)

    def heads(self) -> np.ndarray:
        """The first window of every row of neighbouring windows that share an anchor."""
        if not len(self.first):
            return np.zeros(0, np.int64)
        new = (self.low[1:] != self.low[:-1]) | (self.high[1:] != self.high[:-1]) | (self.text[1:] != self.text[:-1])
        return np.flatnonzero(np.concatenate(([True], new)))

    def anchor(self, rows: np.ndarray) -> np.ndarray:
        """A number for the anchor within its text: start and length of its context."""
        return (self.low[rows] - self.begin[rows]) * 32 + self.high[rows] - self.low[rows]


def _smallest(name: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """In each range of symbols the one whose scrambled name is smallest, the leftmost of equals."""
    place = np.uint64((1 << 26) - 1)
    table = [(mix64(name ^ np.uint64(77)) & ~place) | np.arange(len(name), dtype=np.uint64)]
    step = np.floor(np.log2(np.maximum(end - start, 1))).astype(np.int64)
    for k in range(int(step.max(initial=0))):
        table.append(np.minimum(table[-1][: -(1 << k)], table[-1][1 << k :]))
    found = np.empty(len(start), np.uint64)
    for k, row in enumerate(table):
        mine = step == k
        found[mine] = np.minimum(row[start[mine]], row[end[mine] - (1 << k)])
    return (found & place).astype(np.int64)


_TABLES: dict[int, np.ndarray] = {}


def _geometric(base: int, size: int) -> np.ndarray:
    known = _TABLES.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, 1 << 16), np.uint64(base), dtype=np.uint64)
        known[0] = 1
        known = _TABLES[base] = np.cumprod(known, dtype=np.uint64)
    return known[:size]


def _signed(value: np.ndarray) -> pa.Array:
    return pa.array(value.astype(np.uint64).view(np.int64))


_ID = ["doc_id", "text_key"]


def _take(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    at = pa.array(rows)
    return [batch.column(c).take(at) for c in _ID]


def anchors(texts: DataFrame) -> DataFrame:
    """(doc_id, text_key, name, anchor) of every anchor in use."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        windows = Windows(Texts(batch.column("text")))
        heads = windows.heads()
        columns = [*_take(batch, windows.text[heads]), _signed(windows.name[heads]), pa.array(windows.anchor(heads))]
        return pa.RecordBatch.from_arrays(columns, names=[*_ID, "name", "anchor"])

    return map_batches(texts, work, "doc_id long, text_key long, name long, anchor long")


def _unpack(batch: pa.RecordBatch) -> Texts:
    open_ = zstandard.ZstdDecompressor()
    return Texts(pa.array([open_.decompress(t) for t in batch.column("packed").to_pylist()], pa.binary()))


def packed(texts: DataFrame) -> DataFrame:
    """(doc_id, text_key, packed): texts compressed before they are shuffled."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=10)
        small = [press.compress(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in _ID), pa.array(small, pa.binary())], names=[*_ID, "packed"])

    return map_batches(texts, work, "doc_id long, text_key long, packed binary")


def candidate_windows(texts: DataFrame) -> DataFrame:
    """(name, hot, doc_id, text_key, low, place, hashes) of the windows under anchors that occur more than once.

    A row holds the neighbouring windows of one anchor: the first starts at word ``place``, the anchor's context at ``low``.
    """
    used = materialize(anchors(texts), "anchors")
    often = used.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name", (F.col("n") > HOT).alias("hot"))
    found = used.join(often, "name").groupBy(*_ID).agg(F.collect_list(F.col("anchor") * 2 + F.col("hot").cast("int")).alias("found"))
    found = found.withColumnsRenamed({c: f"_{c}" for c in _ID})
    wanted = packed(texts).join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key")))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        windows = Windows(_unpack(batch))
        heads = windows.heads()
        ends = np.append(heads[1:], len(windows.first))
        listed = batch.column("found")
        owner = np.repeat(np.arange(len(batch)), np.diff(listed.offsets.to_numpy()))
        wanted = np.stack((owner, listed.flatten().to_numpy() >> 1, listed.flatten().to_numpy() & 1)) if len(owner) else np.zeros((3, 0), np.int64)
        key = windows.text[heads] * np.int64(1 << 40) + windows.anchor(heads)
        asked = wanted[0] * np.int64(1 << 40) + wanted[1]
        order = np.argsort(asked, kind="stable")
        at = np.searchsorted(asked[order], key)
        known = at < len(asked)
        known[known] = asked[order][at[known]] == key[known]
        hot = wanted[2][order][at[known]].astype(bool)
        heads, ends = heads[known], ends[known]
        many = ends - heads
        rows = np.repeat(heads - np.cumsum(many) + many, many) + np.arange(many.sum())
        offsets = np.concatenate(([0], np.cumsum(many))).astype(np.int32)
        begin = windows.begin[heads]
        columns = [
            _signed(windows.name[heads]), pa.array(hot), *_take(batch, windows.text[heads]),
            pa.array(windows.low[heads] - begin), pa.array(windows.first[heads] - begin),
            pa.ListArray.from_arrays(pa.array(offsets), _signed(windows.hash[rows])),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["name", "hot", *_ID, "low", "place", "hashes"])

    return map_batches(wanted.select(*_ID, "packed", "found"), work, "name long, hot boolean, doc_id long, text_key long, low long, place long, hashes array<long>")


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(doc_id, text_key, hits): per document its windows that also start earlier, 32 places to a number.

    A hit is ``low`` with the bits of the places before it at which such windows start.
    """
    rows = materialize(candidate_windows(texts), "windows")

    def single(df: DataFrame) -> DataFrame:
        out = df.select("name", *_ID, "low", "place", F.posexplode("hashes").alias("k", "hash"))
        return out.withColumn("place", F.col("place") + F.col("k")).withColumn("k", (F.col("low") - F.col("place")).cast("int"))

    place = F.struct("doc_id", "text_key", "place")
    window = ["name", "k", "hash"]
    # All windows of an anchor's name meet in one partition, where they are compared and folded back to one row an anchor.
    cold = single(rows.where("not hot").repartition("name")).withColumn("first", F.min(place).over(Window.partitionBy(*window)))
    hot = single(rows.where("hot"))
    first = hot.groupBy(*window).agg(F.min(place).alias("first"))
    hot = hot.join(first, window)

    def folded(df: DataFrame) -> DataFrame:
        later = df.where(place != F.col("first"))
        return later.groupBy("name", *_ID, "low").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("bits"))

    both = folded(cold).unionByName(folded(hot))
    return both.groupBy(*_ID).agg(F.collect_list(F.struct("low", "bits")).alias("hits"))


def dedup_substrings(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every row; ``kept`` are the words that stay, joined by one space.

    Null and empty texts have no words and keep the empty string. Texts shorter than a window keep all. A null id counts as
    smaller than any other. Rows equal in id and text are one document: they lose the same words and do not
    count as repeats of one another; of rows that share only the id, the order is that of a hash of their texts. An
    empty table gives no rows; other columns are not read.
    """
    if width != WIDTH:
        raise ValueError("anchors are made for windows of 20 words")
    spark = documents.sparkSession
    small_batches(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text")).select("doc_id", "text_key", "text")
    hits = materialize(repeated_windows(texts), "hits").withColumnsRenamed({c: f"_{c}" for c in _ID})
    joined = packed(texts).join(hits, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key")), "left")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        open_ = zstandard.ZstdDecompressor()
        sizes, removed, digests, kept = [], [], [], []
        for text, hit in zip(batch.column("packed").to_pylist(), batch.column("hits").to_pylist(), strict=True):
            words = open_.decompress(text).split()
            sizes.append(len(words))
            if hit:
                low = np.array([h["low"] for h in hit])[:, None]
                bits = (np.array([h["bits"] for h in hit])[:, None] >> np.arange(width)) & 1
                starts = np.unique((low - np.arange(width))[bits == 1])
                change = np.zeros(len(words) + 1, dtype=np.int64)
                change[starts] += 1
                np.subtract.at(change, starts + width, 1)
                words = [w for w, gone in zip(words, np.cumsum(change[:-1]) > 0, strict=True) if not gone]
            removed.append(sizes[-1] - len(words))
            line = b" ".join(words)
            digests.append(hashlib.sha256(line).hexdigest())
            kept.append(line)
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return map_batches(joined.select(*_ID, "packed", "hits"), work, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op1_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents_of(spark, sf_dir)).drop("kept")


OP1_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS i,
    unnest(list_transform(range(1, len(words) - 18), lambda k: array_to_string(words[k:k + 19], ' '))) AS win
  FROM w WHERE len(words) >= 20),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM later),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM w),
kept AS (
  SELECT p.doc_id, count(g.k) AS n_removed, string_agg(p.word, ' ' ORDER BY p.k) FILTER (g.k IS NULL) AS line
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.k = g.k GROUP BY p.doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
