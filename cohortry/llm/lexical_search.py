"""Ranked lexical search by dense blocked matrix products.

The items form blocks of bounded size. A block has a compact vocabulary, the distinct terms of its items, and a matrix of how
often each item holds each of them. One pass over the documents counts the documents, their terms and the document
frequency of every term of the vocabulary; a second pass turns the documents, tile by tile, into impacts over the same
vocabulary and multiplies both matrices with BLAS, vocabulary tile by vocabulary tile.

All impacts are whole numbers. A vocabulary tile is cut where the largest possible sum of its products could reach 2^53,
so each product of float64 matrices is exact, whatever order BLAS adds in; the tiles are added as 64-bit integers. (Terms that an
item repeats so often that one product could get there are listed several times, with shares of the count.)

Each task keeps the best ``k`` documents of every item over all its tiles: a tile's scores are compared with the item's k-th
best so far, equal ones included, so ties end with the smaller ids. The tasks' lists are merged in two steps, since their number grows
with the table.

Terms are found on the UTF-8 bytes and known by a 64-bit hash and their length. Documents with hashes of other
terms that agree with a vocabulary term in both are the only inexact case: about one in 10^12 per distinct term of the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.base import Texts, documents_of, small_batches

NEAREST = 20
ITEM_CELLS = 16_000_000
"""Items times terms (repeats included) of one block, 128 MB of matrix at most: what the driver holds and sends to the tasks at once."""
TILE_DOCS, TILE_TERMS = 128, 2_048
EXACT = 1 << 53
TOP_IMPACT = 10**6
"""An impact without its weight stays below this: 10^9 tf div (1000 tf + 12 m)."""
MERGE_WAYS = 256

_GAP = np.ones(256, dtype=bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Terms(Texts):
    """Terms instead of words: maximal runs of ASCII letters, digits and everything beyond ASCII, A-Z lower-cased."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        self.bytes = _LOWER[self.bytes]
        self.space = _GAP[self.bytes]
        edge = np.diff(self.space.astype(np.int8))
        self.word_start = np.flatnonzero(edge == -1) + 1
        self.word_end = np.flatnonzero(edge == 1) + 1
        self.word_offsets = np.concatenate((np.searchsorted(self.word_start, self.starts), [len(self.word_start)])).astype(np.int64)

    def keys(self) -> np.ndarray:
        """Hash and length of each term, as one 64-bit value."""
        return self.word_hash(5) + (self.word_end - self.word_start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


class Items:
    """A block of items: the sorted keys of its vocabulary, and which item holds which term how often."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        terms = Terms(pa.array(texts, pa.string()))
        self.ids = ids
        self.keys, term = np.unique(terms.keys(), return_inverse=True)
        pair, self.count = np.unique(terms.text_of_word() * max(len(self.keys), 1) + term, return_counts=True)
        self.item, self.term = np.divmod(pair, max(len(self.keys), 1))

    def found(self, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of the vocabulary's terms in a batch, ordered by text."""
        size = len(self.keys)
        if not size:
            return (np.zeros(0, np.int64),) * 3
        key = terms.keys()
        at = np.minimum(np.searchsorted(self.keys, key), size - 1)
        known = np.flatnonzero(self.keys[at] == key)
        pair, count = np.unique(terms.text_of_word()[known] * size + at[known], return_counts=True)
        return *np.divmod(pair, size), count

    def tiles(self, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, items x terms) per vocabulary tile: no item's sum over a tile reaches ``EXACT``; terms without weight are left out."""
        most = np.maximum(EXACT // (np.maximum(weight, 1) * TOP_IMPACT + 1) - 1, 1)  # of one term, per item
        largest = np.zeros(len(self.keys), dtype=np.int64)
        np.maximum.at(largest, self.term, self.count)
        order = np.argsort(self.term, kind="stable")
        first = np.searchsorted(self.term[order], np.arange(len(self.keys) + 1))
        tiles, open_, room = [], [], EXACT - 1
        for term in np.flatnonzero(weight > 0):
            for part in range(-(-int(largest[term]) // int(most[term]))):
                # The shares of the counts that this listing of the term carries, and the most it can add for any item.
                rows = order[first[term] : first[term + 1]]
                share = np.clip(self.count[rows] - part * most[term], 0, most[term])
                bound = int(share.max()) * int(weight[term]) * TOP_IMPACT
                if open_ and (bound > room or len(open_) == TILE_TERMS):
                    tiles.append(self._tile(open_))
                    open_, room = [], EXACT - 1
                open_.append((int(term), self.item[rows], share))
                room -= bound
        return [*tiles, self._tile(open_)] if open_ else tiles

    def _tile(self, listed: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        matrix = np.zeros((len(self.ids), len(listed)))
        for column, (_, items, share) in enumerate(listed):
            matrix[items, column] = share
        return np.array([term for term, _, _ in listed]), matrix


def corpus_counts(documents: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with repeats, and per vocabulary term the documents that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, total = np.zeros(len(items.keys), np.int64), 0, 0
        for batch in batches:
            terms = Terms(batch.column("text"))
            many += int((terms.n_words > 0).sum())
            total += int(terms.n_words.sum())
            held += np.bincount(items.found(terms)[1], minlength=len(held))
        there = np.flatnonzero(held)
        columns = [np.concatenate(([-2, -1], there)), np.concatenate(([many, total], held[there]))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "n"])

    rows = documents.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}  # one row per vocabulary term of the block
    return counts.get(-2, 0), counts.get(-1, 0), np.array([counts.get(k, 0) for k in range(len(items.keys))], dtype=np.int64)


def term_weights(n_docs: int, held: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], dtype=np.int64)


class Best:
    """The best ``k`` rows of every item so far, by score and then by id, null ids last."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.item = np.zeros(0, np.int64)
        self.score, self.doc, self.null = self.item, self.item, np.zeros(0, bool)
        self.least = np.ones(items, dtype=np.int64)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """``scores``: documents x items."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        self.item = np.concatenate((self.item, item))
        self.score = np.concatenate((self.score, scores[row, item]))
        self.doc, self.null = np.concatenate((self.doc, doc[row])), np.concatenate((self.null, null[row]))
        order = np.lexsort((self.doc, self.null, -self.score, self.item))
        begin = np.searchsorted(self.item[order], np.arange(self.items))
        rank = np.arange(len(order)) - begin[self.item[order]]
        kept = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.least[self.item[full]] = self.score[full]
        self.item, self.score, self.doc, self.null = self.item[kept], self.score[kept], self.doc[kept], self.null[kept]


def _block_scores(documents: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, doc_id, score): per task and item of the block its best ``k`` documents."""
    n_docs, n_terms, held = corpus_counts(documents, items)
    weight = term_weights(n_docs, held)
    tiles = items.tiles(weight * (held > 0))
    sent = documents.sparkSession.sparkContext.broadcast((items, tiles, weight))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, tiles, weight = sent.value
        best = Best(len(items.ids), k)
        for batch in batches:
            terms = Terms(batch.column("text"))
            ids = batch.column("doc_id")
            doc, null = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
            text, term, tf = items.found(terms)
            norm = 75 + 25 * terms.n_words * n_docs // max(n_terms, 1)
            impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * norm[text]))
            for low in range(0, terms.n, TILE_DOCS):
                high = min(low + TILE_DOCS, terms.n)
                part = slice(*np.searchsorted(text, (low, high)))
                if part.start == part.stop:
                    continue
                # Documents of the tile over the terms any of them holds.
                present, column = np.unique(term[part], return_inverse=True)
                dense = np.zeros((high - low, len(present)))
                dense[text[part] - low, column] = impact[part]
                scores = np.zeros((high - low, len(items.ids)), dtype=np.int64)
                for listed, matrix in tiles:
                    at = np.minimum(np.searchsorted(present, listed), len(present) - 1)
                    both = np.flatnonzero(present[at] == listed)
                    if len(both):
                        scores += (dense[:, at[both]] @ matrix[:, both].T).astype(np.int64)
                best.add(scores, doc[low:high], null[low:high])
        columns = [pa.array(best.item), pa.array(best.doc, mask=best.null), pa.array(best.score)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, "item long, doc_id long, score long")


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of at most ``ITEM_CELLS`` items times terms; a longer item is a block of its own."""
    ids, texts, total = [], [], 0
    ordered = items.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text")
    for row in ordered.toLocalIterator():
        size = len(row["text"] or "") // 2 + 1  # terms at most
        if ids and (total + size) * (len(ids) + 1) > ITEM_CELLS:
            yield Items(ids, texts)
            ids, texts, total = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        total += size
    if ids:
        yield Items(ids, texts)


def search(documents: DataFrame, items: DataFrame, k: int = NEAREST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, best first, ties to the smaller id.

    Every row of ``items`` is an item of its own, rows that repeat an id included, and every row of ``documents`` a document;
    a null id comes last among equals. Null and empty texts hold no term: such an item finds nothing, such a document is
    never found and not counted. Documents that share no term with an item are not returned, so an item may have fewer
    rows; empty tables give no rows. Texts of any length are searched whole. Only doc_id, item_id and text are read.

    Items are taken in blocks of bounded size, each with two passes over the documents.
    """
    spark = documents.sparkSession
    small_batches(spark)
    found = None
    for block in item_blocks(items):
        if not len(block.keys):
            continue
        scored = _block_scores(documents, block, k)
        names = spark.createDataFrame([(j, i) for j, i in enumerate(block.ids)], "item long, item_id long")  # one block's items
        ways = Window.partitionBy("item", "_way").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        part = scored.withColumn("_way", F.spark_partition_id() % MERGE_WAYS).withColumn("_rank", F.row_number().over(ways)).where(F.col("_rank") <= k)
        whole = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        merged = part.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
        rows = merged.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = rows if found is None else found.unionByName(rows)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op12_dense_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents_of(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '{_TERM}') AS terms
  FROM documents),
i AS (
  SELECT row_number() OVER () AS j, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '{_TERM}') AS terms
  FROM benchmark),
total AS (SELECT count(*) FILTER (len(terms) > 0)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM d),
norm AS (SELECT k, doc_id, 75 + (25 * len(terms)::BIGINT * n) // l AS m FROM d, total WHERE len(terms) > 0),
tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM d) GROUP BY k, term),
asked AS (SELECT j, item_id, term, count(*) AS c FROM (SELECT j, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term),
weight AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
score AS (
  SELECT j, item_id, norm.k, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN norm USING (k) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= {NEAREST}
"""
