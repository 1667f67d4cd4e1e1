"""The corpus pipeline: documents to packed training sequences, one corpus operator per stage.

Toxic documents go, repeated line chunks are cut out of the rest, of near-duplicates one stays, the sources are mixed to
their target weights (a document taken twice is two rows from then on), and the mix is packed into sequences.
Each stage reads all rows its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm.base import documents_of, labels_of
from cohortry.llm.line_chunks import dedup_document_lines
from cohortry.llm.mixing import take_mix
from cohortry.llm.near_duplicates import keep_one_of_each
from cohortry.llm.packing import pack
from cohortry.llm.toxicity import keep_civil
from cohortry.session import materialize
from starcheck.scratch import ensure_scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below one half; labels come from the ``labels`` table."""
    return keep_civil(docs, labels_of(ensure_scratch(spark), sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without line chunks that an earlier document or place has."""
    ensure_scratch(spark)
    return dedup_document_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates; documents left without words stay."""
    ensure_scratch(spark)
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ensure_scratch(spark)
    return take_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    ensure_scratch(spark)
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack_sequences),
]

ORACLE_SQL = None
"""A trained classifier, hashed signatures and a tokenizer are beyond SQL."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next reads it."""
    docs = documents_of(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
