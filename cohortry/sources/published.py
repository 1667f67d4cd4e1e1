"""Published table versions: a table is the newest manifest, and a manifest names the folders that hold its rows.

A writer puts its rows into a folder of its own beside those in use, and one rename of a small JSON file makes them current. Until
that rename readers see the old version, whole; a writer that dies leaves a folder nobody reads. A manifest maps each
part (a year of a yearly table, or the one part of any other) to the version that wrote it, so a build of one year
carries the other years over by name. The years it replaces are stated: a year without rows becomes an empty one.

Layout below the table's path::

    _versions/00000003.json                                       the manifests; the highest number is current
    version=00000002-1f0c.../measurement_year=2001/part-*.parquet

Two writers that publish at once both want the next number: one rename fails, and nothing it wrote is seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_versions"
VERSION = "version"
WHOLE = ""
"""The one part of a table without partitions."""


class PublishError(RuntimeError):
    """A version that was not made current; the one before it still is."""


@dataclass(frozen=True)
class Manifest:
    """``parts`` maps a partition value as text (``WHOLE`` without partitions) to the folder below the path, NULL for an empty part."""

    number: int
    schema: T.StructType
    partition_by: str | None
    parts: dict[str, str | None]
    rows: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({**vars(self), "schema": self.schema.jsonValue()})

    @staticmethod
    def from_json(text: str) -> Manifest:
        found = json.loads(text)
        return Manifest(**{**found, "schema": T.StructType.fromJson(found["schema"])})


class Store:
    """The files of one table, through Hadoop's file system, wherever it lies."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """Names in a folder, sorted; none if it does not exist."""
        folder = self._at(name)
        return sorted(s.getPath().getName() for s in self._files.listStatus(folder)) if self._files.exists(folder) else []

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.names(MANIFESTS) if n.endswith(".json") and n[0].isdigit()]

    def manifest(self, number: int | None = None) -> Manifest | None:
        """The manifest of a version, by default the current one; NULL for a table never published."""
        numbers = self.numbers()
        if number is None and not numbers:
            return None
        wanted = numbers[-1] if number is None else number
        if wanted not in numbers:
            raise PublishError(f"{self.path} has no version {wanted}")
        lines = self.spark.read.option("wholetext", True).text(f"{self.path}/{MANIFESTS}/{wanted:08}.json").collect()  # one small file
        return Manifest.from_json(lines[0]["value"])

    def folders(self) -> list[str]:
        """The versions' folders in the order they were begun, published or not."""
        return [n for n in self.names() if n.startswith(f"{VERSION}=")]

    def new_folder(self) -> str:
        """A folder for a writer, named after those before it."""
        begun = [int(n.removeprefix(f"{VERSION}=")[:8]) for n in self.folders()]
        return f"{VERSION}={max([0, *begun]) + 1:08}-{uuid.uuid4().hex[:12]}"

    def commit(self, manifest: Manifest) -> None:
        """Make a version current by one rename, which fails if another writer has taken the number."""
        waiting = f"{MANIFESTS}/.{uuid.uuid4().hex}"
        out = self._files.create(self._at(waiting))
        out.write(bytearray(manifest.to_json().encode()))
        out.close()
        target = self._at(f"{MANIFESTS}/{manifest.number:08}.json")
        context = self._fs.FileContext.getFileContext(target.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        try:
            context.rename(self._at(waiting), target, options)
        except Exception as error:
            self._files.delete(self._at(waiting), False)
            raise PublishError(f"{self.path}: version {manifest.number} was published by another writer") from error

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


def publish(df: DataFrame, path: str, partition_by: str | None = None, replaces: Iterable[object] | None = None) -> Manifest:
    """Write ``df`` as a new version of the table at ``path`` and make it current.

    Without ``partition_by`` the whole table is replaced. With it, ``replaces`` states the partition values the version replaces: each
    of them holds the rows of ``df`` afterwards, none if ``df`` has none; the others stay, and a row of another value fails
    the write. Without ``replaces`` the whole table is replaced.
    """
    spark, store = df.sparkSession, Store(df.sparkSession, path)
    current = store.manifest()
    if current is not None and current.partition_by != partition_by:
        raise PublishError(f"{path} is partitioned by {current.partition_by}, not by {partition_by}")
    folder = store.new_folder()
    stated = None if replaces is None or partition_by is None else {str(v) for v in replaces}
    sent = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    if stated is not None:
        outside = F.col(partition_by).isNull() | ~F.col(partition_by).cast("string").isin(*stated)
        counts.append(F.count_if(outside).alias("outside"))
    writer = df.observe(sent, *counts).write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{path}/{folder}")
    if stated is not None and sent.get["outside"]:
        raise PublishError(f"{path}: {sent.get['outside']} rows lie outside {partition_by} {', '.join(sorted(stated))}")
    return finish(store, folder, df.schema, partition_by, stated, sent.get["rows"])


def finish(store: Store, folder: str, schema: T.StructType, partition_by: str | None, stated: set[str] | None, rows: int) -> Manifest:
    """Compare what a version's folder holds with the rows sent, then make it current."""
    spark, path = store.spark, store.path
    if partition_by is None:
        stored = {WHOLE: spark.read.schema(schema).parquet(f"{path}/{folder}").count() if rows else 0}
    else:
        # Counts by partition come from the files' footers and their folders.
        back = spark.read.schema(schema).parquet(f"{path}/{folder}") if rows else spark.createDataFrame([], schema)
        stored = {str(r[0]): r[1] for r in back.groupBy(partition_by).count().collect()}  # one row per partition
    if sum(stored.values()) != rows:
        raise PublishError(f"{path}: sent {rows} rows, stored {sum(stored.values())}")
    current = store.manifest()
    keep = current is not None and stated is not None
    parts = {k: v for k, v in current.parts.items() if k not in stated} if keep else {}
    kept_rows = {k: n for k, n in current.rows.items() if k not in stated} if keep else {}
    written = {k: None if not n else folder if partition_by is None else f"{folder}/{partition_by}={k}" for k, n in stored.items()}
    for value in (stated or set()) - set(written):
        written[value], stored[value] = None, 0
    number = current.number + 1 if current is not None else 1
    manifest = Manifest(number, T.StructType.fromJson(schema.jsonValue()), partition_by, {**parts, **written}, {**kept_rows, **stored})
    store.commit(manifest)
    return manifest


def open_version(spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """A published table, its current version by default; filters on the partition column prune its folders."""
    manifest = Store(spark, path).manifest(version)
    if manifest is None:
        raise PublishError(f"{path} was never published")
    schema = schema or manifest.schema
    folders = sorted(f"{path}/{folder}" for folder in manifest.parts.values() if folder)
    if not folders:
        return spark.createDataFrame([], schema)
    versioned = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(versioned).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(Store(spark, path).numbers())


def expire_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete the manifests but the last ``keep``, and the folders none of those needs; returns the folders.

    To be called while nobody writes the table: a folder that is still being written is in no manifest yet.
    """
    store = Store(spark, path)
    numbers = store.numbers()
    kept = numbers[-max(keep, 1) :]
    needed = {folder.split("/")[0] for n in kept for folder in store.manifest(n).parts.values() if folder}
    gone = [n for n in store.folders() if n not in needed]
    for number in numbers[: -max(keep, 1)]:
        store.delete(f"{MANIFESTS}/{number:08}.json")
    for name in gone:
        store.delete(name)
    return gone
