"""Writers for raw tables, marts, the audit log and small report files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.functions.dates import as_date
from cohortry.operators.quality import unexpired
from cohortry.schemas import AUDIT_LOG, CONDITION_MAP_SEED, RAW_TABLES
from cohortry.sources.published import Store, finish, open_version, publish
from cohortry.sources.readers import RawTables, landing_folder, misfits, read_audit_log, read_raw, read_records


class LoadError(RuntimeError):
    """More records of a load do not fit than the caller allows."""


def load_table(df: DataFrame, base: str, table: str) -> int:
    """Replace a table and return its row count, read back and compared with the rows sent.

    The old rows stay current until the new ones are all there (``published``).
    """
    return sum(publish(df, f"{base}/{table}").rows.values())


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, base: str, table: str, quoted_newlines: bool = True, max_rejected: int = 0
) -> int:
    """Load one CSV file, folder or glob into a typed table and return its row count.

    One job reads the files, judges every record and writes all of them. Records with a value that does not fit its type or with
    more fields than the header are set aside as text (``read_rejected``), with what is wrong in ``_misfits``;
    more than ``max_rejected`` of them fail the load, and the table keeps its rows. Undeclared columns are kept as text.
    """
    text = read_records(spark, path, schema, quoted_newlines)
    own = [name for name in text.columns if name not in ("_record", "_surplus")]
    kinds = {f.name: f.dataType for f in schema.fields}
    good = F.col("_misfits").isNull()
    column = [F.col(f"`{name}`").try_cast(kinds.get(name, T.StringType())) for name in own]
    judged = text.withColumn("_misfits", misfits(schema)).select(
        *[F.when(good, c).alias(name) for c, name in zip(column, own, strict=True)],
        F.when(~good, F.struct(*[F.col(f"`{name}`") for name in own])).alias("_fields"),
        "_record",
        "_misfits",
        F.when(good, "good").otherwise("rejected").alias("verdict"),
    )
    seen = Observation()
    judged_rows = judged.observe(seen, F.count_if(F.col("_misfits").isNull()).alias("good"), F.count_if(F.col("_misfits").isNotNull()).alias("rejected"))
    store = Store(spark, f"{base}/{table}")
    folder = store.new_folder()
    judged_rows.write.partitionBy("verdict").parquet(f"{store.path}/{folder}")
    if seen.get["rejected"] > max_rejected:
        raise LoadError(f"{table}: {seen.get['rejected']} rows do not fit, see {store.path}/{folder}/verdict=rejected")
    stored = T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in own])
    return sum(finish(store, f"{folder}/verdict=good", stored, None, None, seen.get["good"]).rows.values())


def ingest(
    spark: SparkSession,
    csv_base: str,
    base: str,
    run_date: str | dt.date | None = None,
    splittable: Collection[str] = (),
    max_rejected: int = 0,
) -> RawTables:
    """Load the six raw CSV tables and the condition map into Parquet and return them.

    A table's files are ``<csv_base>/<table>.csv`` (a file or a folder), or with ``run_date`` the landing folder of
    that run. Tables named in ``splittable`` have no quoted line breaks, so their large files are read in parallel.
    """
    for table, schema in {**RAW_TABLES, "condition_map": CONDITION_MAP_SEED}.items():
        path = f"{csv_base}/{table}.csv" if run_date is None else landing_folder(csv_base, table, run_date)
        load_csv(spark, path, schema, base, table, table not in splittable, max_rejected)
    return read_raw(spark, base)


def write_mart(df: DataFrame, base: str, mart: str, year: int | None = None) -> DataFrame:
    """Publish a mart as a new version and return it as read back.

    A yearly mart, one with a column ``measurement_year``, is partitioned by it. With ``year`` that year is replaced, by nothing
    if ``df`` has no row of it, the other years stay, and that year is returned; a row of another year is an error. Without, all
    years are replaced.
    """
    yearly = "measurement_year" if "measurement_year" in df.columns else None
    stamped = df.withColumn("_loaded_at", F.current_timestamp())
    publish(stamped, f"{base}/{mart}", yearly, [year] if yearly and year is not None else None)
    back = open_version(df.sparkSession, f"{base}/{mart}").drop("_loaded_at")
    return back.where(F.col(yearly) == year) if yearly and year is not None else back


def append_audit(rows: DataFrame, path: str) -> None:
    """Append a run's results, one partition per day, clustered for skipping by check and table.

    A run has a few dozen rows, so a day's rows fit one task. A missing required value fails the
    append.
    """
    required = {
        field.name: F.when(F.col(field.name).isNotNull(), F.col(field.name)).otherwise(
            F.raise_error(F.lit(f"audit rows need {field.name}"))
        )
        for field in AUDIT_LOG.fields
        if not field.nullable
    }
    (
        rows.withColumns(required)
        .withColumn("_inserted_at", F.current_timestamp())
        .withColumn("run_date", F.to_date("run_timestamp"))
        .repartition("run_date")
        .sortWithinPartitions("run_date", "check_type", "table_name")
        .write.mode("append")
        .partitionBy("run_date")
        .parquet(path)
    )


def expire_audit(spark: SparkSession, path: str, as_of: str | dt.date, keep_days: int = 365) -> list[str]:
    """Delete the day folders past retention and return their dates. No row is read or rewritten."""
    log = read_audit_log(spark, path).select("run_date")
    expired = log.where(log["run_date"] < F.date_sub(as_date(as_of), keep_days)).distinct()
    days = sorted(str(row["run_date"]) for row in expired.collect())  # partition values only
    for day in days:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run_date={day}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return days


def current_audit(spark: SparkSession, path: str, as_of: str | dt.date, keep_days: int = 365) -> DataFrame:
    """The unexpired part of the audit log."""
    return unexpired(read_audit_log(spark, path), as_of, keep_days)


def export_report(report: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """A report as headed CSV files, ordered across files where ``order_by`` is given; a small report is one file."""
    ordered = report.orderBy(*order_by) if order_by else report
    ordered.write.mode("overwrite").option("header", True).csv(path)
