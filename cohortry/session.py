"""Session settings the library relies on, and the one place intermediate tables are written."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Service dates are UTC dates, whatever zone the driver runs in.
    "spark.sql.session.timeZone": "UTC",
    # A bad cast or a zero divisor is an error, never a silent NULL.
    "spark.sql.ansi.enabled": "true",
    # Run-time re-planning: coalesced shuffles, size-checked broadcast, split of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession, shuffled_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session.

    ``shuffled_bytes`` is the expected size of the largest shuffle. Adaptive execution merges small
    shuffle partitions but never cuts one below what was planned, so large data needs many to start.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffled_bytes is not None:
        planned = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(shuffled_bytes) // SHUFFLE_TARGET_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", planned)
    return spark


def build_session(app_name: str = "cohortry", master: str | None = None, **settings: object) -> SparkSession:
    """A session with the library's settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    # Recording a call site per column expression costs more than planning these queries does.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``, or what the context was given."""
    chosen = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not chosen:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return chosen.rstrip("/")


def _session_scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/cohortry-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path of this session below the shared folder."""
    return f"{_session_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete what this session has materialized, once no DataFrame that reads it is needed."""
    delete_scratch(spark, _session_scratch(spark))
    _owned.clear()


_owned: dict[str, list] = {}
"""Per scratch folder weak references to the JVM's file relations that read it."""


def owned(df: DataFrame, path: str) -> DataFrame:
    """``df``, with the scratch folder ``path`` belonging to its file scans.

    Every plan derived from ``df`` holds the same relations, so they live as long as anything can still read the folder. Once
    the JVM has collected them, the next ``sweep_scratch`` deletes it.
    """
    reference = df.sparkSession._jvm.java.lang.ref.WeakReference
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    relations = [leaves.apply(k) for k in range(leaves.size())]
    _owned[path] = [reference(leaf.relation()) for leaf in relations if leaf.getClass().getSimpleName() == "LogicalRelation"]
    return df


def sweep_scratch(spark: SparkSession, collect: bool = False) -> int:
    """Delete the scratch folders that nothing can read any more and return how many are left.

    ``collect`` runs the garbage collections of both sides first; without it only folders already found unreachable go.
    """
    # The driver's side gives its handles up a little later than it is asked to.
    for _ in range(3 if collect else 0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.1)
    for path, references in list(_owned.items()):
        if all(r.get() is None for r in references):
            _owned.pop(path)
            delete_scratch(spark, path)
    return len(_owned)


def materialize(df: DataFrame, label: str, drop_shuffled: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several branches read the same derived table: the lineage is cut, a lost
    executor costs no recomputation, and each reader prunes its own columns. The folder goes with its last reader (``owned``).
    With ``drop_shuffled`` the files that were shuffled for it go as soon as it is written: nothing reads them again, and the
    driver may not collect its garbage for long.
    """
    spark = df.sparkSession
    sweep_scratch(spark)
    path = scratch_path(spark, label)
    if not drop_shuffled:
        df.write.parquet(path)
        return owned(spark.read.schema(df.schema).parquet(path), path)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return owned(spark.read.schema(df.schema).parquet(path), path)
