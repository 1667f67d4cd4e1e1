"""Counts and extremes of published tables from what was recorded when they were written: manifests and Parquet footers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.operators import quality
from cohortry.sources.published import Manifest, PublishError, Store

PUSHED = {
    # Spark answers counts and extremes from the footers alone where its Parquet source is the one that takes aggregates.
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}

NO_STATISTICS = "No min/max found"
"""Spark's message where a file's footer does not answer."""


def _manifest(spark: SparkSession, path: str) -> Manifest:
    found = Store(spark, path).manifest()
    if found is None:
        raise PublishError(f"{path} was never published")
    return found


def extremes(spark: SparkSession, folder: str, column: str, schema: T.StructType) -> DataFrame:
    """(low, high) of a column of the Parquet files in a folder, planned to read footers only.

    ``schema`` must list the files' columns from the first one on: Spark finds a column's statistics by its place.
    """
    session = spark.newSession()  # settings of its own, the same context
    for key, value in PUSHED.items():
        session.conf.set(key, value)
    return session.read.schema(schema).parquet(folder).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def newest(spark: SparkSession, path: str, column: str) -> object:
    """The largest value of a column of a published table, NULL if it has none.

    Each part is asked for its footers; a part with a file that lacks the statistics, or a type whose statistics cannot be
    used, is scanned, that column alone.
    """
    manifest = _manifest(spark, path)
    schema = T.StructType([f for f in manifest.schema.fields if f.name != manifest.partition_by])
    found = []
    for folder in manifest.parts.values():
        if folder is None:
            continue
        try:
            high = extremes(spark, f"{path}/{folder}", column, schema).first()["high"]
        except (PySparkException, Py4JJavaError) as error:
            if NO_STATISTICS not in str(error):
                raise
            high = spark.read.schema(schema).parquet(f"{path}/{folder}").agg(F.max(column)).first()[0]
        if high is not None:
            found.append(high)
    return max(found, default=None)


def stored_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Row count per published table, from the manifests; no file is read."""
    rows = [(name, sum(_manifest(spark, path).rows.values())) for name, path in paths.items()]
    return spark.createDataFrame(rows, "table_name string, row_count bigint")


def stored_freshness(
    spark: SparkSession, path: str, table: str, column: str, as_of: str | dt.date, max_days: int = quality.MAX_STALE_DAYS
) -> DataFrame:
    """``quality.freshness`` of a published table, from its footers."""
    kind = _manifest(spark, path).schema[column].dataType
    one = spark.createDataFrame([(newest(spark, path, column),)], T.StructType([T.StructField(column, kind)]))
    return quality.freshness(table, one, column, as_of, max_days)
