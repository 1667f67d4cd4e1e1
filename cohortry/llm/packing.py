"""Packing by cutting-stock column generation.

Every document is tokenized once and cut into full pieces and one remainder. The histogram of piece lengths (in units of
``UNIT`` tokens, rounded up: at most ``LENGTH / UNIT`` classes) is a cutting-stock problem: how few sequences can hold
those pieces. Its linear program is solved over patterns (how many pieces of each class share a sequence); a knapsack
dynamic program prices new patterns until none helps. Patterns are rounded down, first-fit decreasing packs what
that leaves open, and the pieces, ranked within their class by shards, take the patterns' places by arithmetic alone.
Only the histogram goes to the driver; what returns is one row per pattern and class.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.base import documents_of, small_batches
from cohortry.session import materialize

LENGTH, UNIT, END = 2048, 8, 1
ROUNDS = 3000
"""Pivots of the linear program, at most; any basis met on the way is a valid, only looser, packing."""
NEAR = 5e-4
CACHE = 500_000
"""Words a worker remembers with their ids."""


_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
"""The tokenizer's own split pattern (a fixed value), for lower-case printable ASCII and Latin letters."""
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
"""The byte alphabet of the vocabulary: bytes without a printed form stand for code points from 256 on."""


class _Ids:
    """Token ids of texts as little-endian bytes, looked up by word.

    The tokenizer drops white space and never merges across it, and its special strings hold none, so the words
    between spaces and line feeds are encoded independently; other white space stays inside a word. A word of printable
    ASCII and composed Latin letters is its own normal form but for its case, so its parts go straight to the merges; any
    other word, and one that may hold a special string, takes the whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.parts = Tokenizer.from_file(path), {"": b""}, {}
        self.merge = self.tokenizer.model.tokenize

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            found = self.parts[text] = array("I", [t.id for t in self.merge(text if text.isascii() else text.encode().decode("latin-1").translate(_BYTES))]).tobytes()
        return found

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known, new = {"": b""}, list(words)
        if len(self.parts) > CACHE:
            self.parts = {}
        odd = []
        for word in new:
            if _PLAIN.fullmatch(word) and "<|" not in word:
                self.known[word] = b"".join([self.part(x) for x in _PARTS.findall(word.lower())])
            elif word:
                odd.append(word)
        for low in range(0, len(odd), 10_000):
            part = odd[low : low + 10_000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[word] = array("I", found.ids).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        self.learn(set().union(*split))
        return (b"".join(map(self.known.__getitem__, words)) for words in split)


_LOADED: dict[str, _Ids] = {}


def cut_pieces(documents: DataFrame, tokenizer_path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece: full pieces from the front, then the remainder."""
    small_batches(documents.sparkSession, 200)
    last = np.array([end], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer_path not in _LOADED:
            _LOADED[tokenizer_path] = _Ids(tokenizer_path)
        ids = _LOADED[tokenizer_path]
        for batch in batches:
            rows = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), ids.encode([t or "" for t in batch.column("text").to_pylist()]), strict=True):
                found += last
                total = len(found) // 4
                for start in range(0, total, length):
                    piece = found[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)


def _price(value: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: the most valuable pattern of pieces (sizes ascending) in ``room``."""
    best, choice = np.zeros(room + 1), [-1] * (room + 1)
    fitting = np.searchsorted(size, np.arange(room + 1), side="right").tolist()
    for space in range(1, room + 1):
        best[space] = best[space - 1]
        if fitting[space]:
            gain = best[space - size[: fitting[space]]] + value[: fitting[space]]
            k = gain.argmax()
            if gain[k] > best[space] + 1e-12:
                best[space], choice[space] = gain[k], k
    pattern, space = np.zeros(len(size)), room
    while space > 0:
        k = choice[space]
        if k < 0:
            space -= 1
        else:
            pattern[k] += 1
            space -= size[k]
    return float(best[room]), pattern


def _inverse(basis: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots. Plain array arithmetic: a threaded solver stalls on a driver with busy cores."""
    many = len(basis)
    work = np.hstack((basis, np.eye(many)))
    for k in range(many):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        factor = work[:, k].copy()
        factor[k] = 0
        rows = np.flatnonzero(factor)
        work[rows] -= factor[rows, None] * work[k]
    return work[:, many:]


def solve_patterns(size: np.ndarray, demand: np.ndarray, room: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often the linear program uses each; classes ascend in size and all have demand."""
    many = len(size)
    basis = np.diag((room // size).astype(float))
    cost, inverse = np.ones(many), np.diag(1.0 / (room // size))
    for turn in range(rounds):
        if turn % 100 == 99:
            inverse = _inverse(basis)
        dual = (cost[:, None] * inverse).sum(axis=0)
        worst = int(dual.argmin())
        if dual[worst] < -1e-9:  # more than the demand may be covered
            column, price = -np.eye(many)[worst], 0.0
        else:
            worth, column = _price(np.maximum(dual, 0), size, room)
            price = 1.0
            if worth <= 1 + NEAR:  # the program's value is within this share of its optimum (Farley's bound)
                break
        level, step = (inverse * demand).sum(axis=1), (inverse * column).sum(axis=1)
        ratio = np.where(step > 1e-9, np.maximum(level, 0) / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if np.isinf(ratio[out]):
            break
        basis[:, out], cost[out] = column, price
        inverse[out] /= step[out]
        others = np.arange(many) != out
        inverse[others] -= np.outer(step[others], inverse[out])
    level = (_inverse(basis) * demand).sum(axis=1)
    used = (cost > 0) & (level > 0)
    return basis.T[used], level[used]


def plan_sequences(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, repetitions) for a histogram of piece sizes in units: the rounded program, then first-fit decreasing."""
    size = np.array(sorted(k for k, n in histogram.items() if n > 0), dtype=np.int64)
    if not len(size):
        return []
    demand = np.array([histogram[int(k)] for k in size], dtype=float)
    plan, open_ = [], demand.copy()
    for pattern, level in zip(*solve_patterns(size, demand, room), strict=True):
        # No more than is still open, so that no place stays empty.
        whole = int(min(np.floor(level + 1e-9), *(open_[pattern > 0] // pattern[pattern > 0])))
        if whole > 0:
            plan.append(({int(size[k]): int(pattern[k]) for k in np.flatnonzero(pattern)}, whole))
            open_ -= whole * pattern
    while open_.sum() > 0:
        space, pattern = room, np.zeros(len(size))
        for k in range(len(size) - 1, -1, -1):
            pattern[k] = min(open_[k], space // size[k])
            space -= pattern[k] * size[k]
        whole = int(min(open_[pattern > 0] // pattern[pattern > 0]))
        plan.append(({int(size[k]): int(pattern[k]) for k in np.flatnonzero(pattern)}, whole))
        open_ -= whole * pattern
    return plan


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per class the rows (first rank, first sequence, pieces per sequence, first slot), by first rank."""
    taken: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    first = 0
    for pattern, whole in plan:
        slot = 0
        for size, many in sorted(pattern.items(), reverse=True):
            found.setdefault(size, []).append((taken.get(size, 0), first, many, slot))
            taken[size] = taken.get(size, 0) + many * whole
            slot += many
        first += whole
    return {size: np.array(rows, dtype=np.int64) for size, rows in found.items()}


def pack_pieces(pieces: DataFrame, length: int = LENGTH, unit: int = UNIT) -> DataFrame:
    """``pieces`` (written: they are read three times) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    classed = pieces.withColumn("class", F.ceil(F.col("length") / unit).cast("int"))
    classed = classed.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)).cast("int"))

    # Ranks within a class: rows are numbered per shard, and each shard starts where those before it end.
    counts = classed.groupBy("class", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan_sequences(histogram, length // unit))
    names = [*pieces.columns, "sequence_id", "slot"]

    inside = Window.partitionBy("class", "shard").orderBy("doc_id", "start", "ids_crc32")
    ranked = classed.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["class", "shard"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).select(*pieces.columns, "class", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = batch.column("class").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
            for size in np.unique(kind):
                rows, table = np.flatnonzero(kind == size), places[int(size)]
                at = table[np.searchsorted(table[:, 0], rank[rows], side="right") - 1]
                over = rank[rows] - at[:, 0]
                sequence[rows], slot[rows] = at[:, 1] + over // at[:, 2], at[:, 3] + over % at[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sequence), pa.array(slot)], names=names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, slot long"
    placed = ranked.mapInArrow(place, schema)
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).drop("slot")


def pack_documents(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every row.

    Null and empty texts are the end token alone; rows that repeat are packed as often as they stand there; a null id stays
    null; an empty table gives no rows; other columns are not read. A sequence holds at most ``LENGTH`` tokens.
    """
    return pack_pieces(materialize(cut_pieces(documents, tokenizer_path), "pieces"))


def pack(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents, public_tokenizers.path("word_bpe_49k.json"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents_of(spark, sf_dir).select("doc_id", "text"))
