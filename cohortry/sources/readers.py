"""Readers. Every read states its schema; nothing is inferred."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.schemas import AUDIT_LOG, CONDITION_MAP_SEED, RAW_TABLES
from cohortry.sources.csv_records import SURPLUS, SchemaError as SchemaError, read_records as read_records
from cohortry.sources.published import Store, is_published, open_version



class RawTables:
    """The six raw tables and the condition map seed, each read when first asked for."""

    def __init__(self, read: Callable[[str], DataFrame]):
        self._read = read

    @cached_property
    def patients(self) -> DataFrame:
        return self._read("patients")

    @cached_property
    def encounters(self) -> DataFrame:
        return self._read("encounters")

    @cached_property
    def conditions(self) -> DataFrame:
        return self._read("conditions")

    @cached_property
    def procedures(self) -> DataFrame:
        return self._read("procedures")

    @cached_property
    def medications(self) -> DataFrame:
        return self._read("medications")

    @cached_property
    def providers(self) -> DataFrame:
        return self._read("providers")

    @cached_property
    def condition_map(self) -> DataFrame:
        return self._read("condition_map")

    def as_dict(self) -> dict[str, DataFrame]:
        """The six raw tables by name."""
        return {name: getattr(self, name) for name in RAW_TABLES}


def misfits(schema: T.StructType) -> Column:
    """What is wrong with a record: the declared columns whose text does not fit their type, and ``SURPLUS``; NULL if nothing is."""
    failing = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]
    return F.nullif(F.concat_ws(", ", *failing, F.when(F.col("_surplus"), F.lit(SURPLUS))), F.lit(""))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, quoted_newlines: bool = True, where: Column | None = None
) -> DataFrame:
    """A headed CSV file, folder or glob, bound by name (``read_records``) and cast to the declared types.

    Nothing is lost silently: under ANSI a value that does not fit is an error, and so is a record with surplus fields.
    """
    text = read_records(spark, path, schema, quoted_newlines, where)
    surplus = F.raise_error(F.concat(F.lit("more fields than the header: "), F.col("_record"))).cast("boolean")
    text = text.where(F.when(F.col("_surplus"), surplus).otherwise(True)).drop("_record", "_surplus")
    return text.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in schema.fields})


def read_condition_map(spark: SparkSession, path: str) -> DataFrame:
    """The seed file with its pinned column types."""
    return read_csv(spark, path, CONDITION_MAP_SEED)


def landing_folder(base: str, table: str, run_date: str | dt.date) -> str:
    """Folder of one table's files of one run."""
    return f"{base}/{table}/ds={run_date}"


def read_landed_csv(
    spark: SparkSession, base: str, table: str, schema: T.StructType, run_date: str | dt.date | None = None
) -> DataFrame:
    """Landed files of a table with their run date; ``run_date`` prunes to one folder."""
    dated = T.StructType([*schema.fields, T.StructField("ds", T.DateType())])
    one = None if run_date is None else F.col("ds") == F.lit(str(run_date)).cast("date")
    return read_csv(spark, f"{base}/{table}", dated, where=one)


def read_table(spark: SparkSession, base: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A table below ``base``: the current version of a published one, or a plain Parquet folder."""
    path = f"{base}/{table}"
    if is_published(spark, path):
        return open_version(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_rejected(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The records that the last load of a table set aside, published or not: their fields as text, ``_record`` and ``_misfits``."""
    store = Store(spark, f"{base}/{table}")
    folder = store.folders()[-1]
    if "verdict=rejected" not in store.names(folder):
        return spark.createDataFrame([], "_record string, _misfits string")
    return spark.read.parquet(f"{store.path}/{folder}/verdict=rejected").select("_fields.*", "_record", "_misfits")


def read_raw(spark: SparkSession, base: str) -> RawTables:
    """Raw tables that ``ingest`` has written."""
    schemas = {**RAW_TABLES, "condition_map": CONDITION_MAP_SEED}
    return RawTables(lambda table: read_table(spark, base, table, schemas[table]))


def read_mart(spark: SparkSession, base: str, mart: str, year: int | None = None, version: int | None = None) -> DataFrame:
    """A published mart, its current version by default; a year prunes the scan to that year's folder."""
    df = open_version(spark, f"{base}/{mart}", version=version)
    return df if year is None else df.where(F.col("measurement_year") == year)


class StoredMarts:
    """The published marts below a folder, each opened at its current version when first asked for."""

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self._base = spark, base
        self._open: dict[str, DataFrame] = {}

    def names(self) -> list[str]:
        return [name for name in Store(self._spark, self._base).names() if is_published(self._spark, f"{self._base}/{name}")]

    def years(self, mart: str) -> list[int]:
        """The years a mart holds, empty ones included; from its manifest, no file is read."""
        return sorted(int(year) for year in Store(self._spark, f"{self._base}/{mart}").manifest().parts)

    def mart(self, name: str, year: int | None = None) -> DataFrame:
        """A mart, one year of it if given. All calls see the version of the first one."""
        if name not in self._open:
            self._open[name] = read_mart(self._spark, self._base, name)
        df = self._open[name]
        return df if year is None else df.where(F.col("measurement_year") == year)


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """The audit log; a log that was never written is empty."""
    schema = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in AUDIT_LOG.fields],
            T.StructField("_inserted_at", T.TimestampType()),
            T.StructField("run_date", T.DateType()),
        ]
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
