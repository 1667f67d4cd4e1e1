"""Token counts: pieces counted once per distinct pre-token, joined with each document's pre-token frequencies.

The vocabulary has no piece in which a space follows another character, and none with a line feed beside another
character (``_check_cuts`` makes sure), so no merge crosses the start of a run of spaces or a line feed: those cut
a text into pre-tokens that are encoded independently of one another.

1. every task counts its pre-tokens; summed globally, they are the distinct pre-tokens of the corpus;
2. each distinct pre-token is encoded once and only its number of pieces is kept;
3. pre-tokens that make up at least one in ``HOT`` of all occurrences, of which there can be at most ``HOT``, travel
   to the tasks as a broadcast, so no join ever meets a hot key; every other (document, pre-token, frequency) row is
   joined on the pre-token and summed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.base import documents_of, small_batches
from cohortry.session import materialize

HOT = 1 << 21
"""Bounds the broadcast pre-tokens, as each holds more than ``1 / HOT`` of all occurrences."""
MAX_HOT_BYTES = 32
"""Longer pre-tokens are never broadcast."""
FLUSH = 400_000
"""Distinct pre-tokens a task holds before it hands them on."""
LIMIT = 4096

_SPACE = "▁"  # the vocabulary's sign for a space; a literal one in a text is the same symbol
_PRE = re.compile("▁+[^▁\n]*|\n|[^▁\n]+")


def _pre_tokens(text: str) -> list[str]:
    """The text with the library's leading space, cut before every run of spaces and around every line feed."""
    return _PRE.findall(_SPACE + text.replace(" ", _SPACE)) if text else []


def _check_cuts(model) -> None:
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if _SPACE in piece.lstrip(_SPACE) or ("\n" in piece and len(piece) > 1):
            raise ValueError(f"piece {i} crosses a pre-token boundary")


def _count_pieces(model, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token inside its text."""
    # The library puts a space before what it encodes. A pre-token that starts with one gives it up; any other
    # follows a line feed, and the two pieces of that prefix are taken off.
    asked = [t[1:] if t[0] == _SPACE else "\n" + t for t in tokens]
    sizes = [len(x) for x in model.encode(asked, num_threads=1)]
    return [1 if t in (_SPACE, "\n") else n - (t[0] != _SPACE) * 2 for t, n in zip(tokens, sizes, strict=True)]


def count_tokens(documents: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; other columns are ignored.

    Null and empty texts have 0 bytes and 0 tokens, an empty table gives no rows, rows that repeat (doc_id and text)
    come back as often as they stand there, and a null id stays null.
    """
    spark = documents.sparkSession
    small_batches(spark)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_pydict({"token": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return rows

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(_pre_tokens(text))
            if len(held) > FLUSH:
                yield out()
        yield out()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        _check_cuts(model)
        for batch in batches:
            counted = pa.array(_count_pieces(model, batch.column("token").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counted], names=["token", "n", "pieces"])

    distinct = texts.select("text").mapInArrow(tally, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = materialize(distinct.mapInArrow(pieces, "token string, n long, pieces long"), "pieces")

    total = counted.agg(F.sum("n")).first()[0] or 0
    top = counted.where((F.octet_length("token") <= MAX_HOT_BYTES) & (F.col("n") * HOT >= total))
    hot = spark.sparkContext.broadcast({r["token"]: r["pieces"] for r in top.select("token", "pieces").collect()})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value.get
        for batch in batches:
            ids, keys, tokens, counts, sizes = [], [], [], [], []
            raw = batch.column("text")
            for doc_id, key, text, n_bytes in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), raw.to_pylist(), pc.binary_length(raw).to_pylist(), strict=True):
                found = _pre_tokens(text)
                have = [known(t) for t in found]
                total = sum(x for x in have if x is not None)
                rest = Counter(t for t, x in zip(found, have, strict=True) if x is None)
                # One row stands for the document itself, with what the broadcast part already counts. Its token
                # is none that a text can have, and differs by document (few digits do), so the join below deals it out evenly.
                ids += [doc_id] * (1 + len(rest))
                keys += [key] * (1 + len(rest))
                tokens += [f"\n{key & 0xFFFFFFF:x}", *rest]
                counts += [total, *rest.values()]
                sizes += [n_bytes] + [None] * len(rest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(tokens, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["doc_id", "key", "token", "n", "n_bytes"],
            )

    keyed = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    rows = keyed.mapInArrow(frequencies, "doc_id long, key long, token string, n long, n_bytes long")
    summed = (
        rows.join(counted.select("token", "pieces"), "token", "left")
        .groupBy("doc_id", "key")
        .agg(
            F.sum("n_bytes").alias("n_bytes"),
            F.sum(F.when(F.col("n_bytes").isNull(), F.col("n") * F.col("pieces")).otherwise(F.col("n"))).alias("tokens"),
            F.count("n_bytes").alias("copies"),
        )
    )
    # Repeated rows were summed together and have equal shares.
    return summed.select(
        "doc_id",
        F.expr("n_bytes div copies").alias("n_bytes"),
        F.expr("tokens div copies").alias("n_tokens"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(documents_of(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
