"""Sharding by proportional stratified interleaving.

The rows of every source are put into a seeded random order. A row of rank r (from 0) among the n of its source then lies at
the fraction ``(r + t) / n``, where t is a random offset of the source between 0 and 1, so sources of a few rows do not all
lie at one place. Sorted by fraction, all sources are interleaved in proportion, and that order is cut into shards whose row
counts differ by one at most (the law ``rows``); hence every shard holds each source's share, within a row or two.

Neither a source nor the table is ever sorted in one task. Both ranks are found in two steps: rows are counted per bucket of
the order, a bucket's rows are numbered by themselves, and the number of rows in the buckets before is added. Buckets
are even, since draws and fractions are; their number grows with the table. Rows equal in id, source, size and checksum
are counted before they are ordered and spread again afterwards, so a hot group of copies is one row in between.

Equal texts are not kept in one shard, which would contradict equal counts: a group may hold a third of all rows.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.base import documents_of
from cohortry.session import materialize

SHARDS, SEED = 40, "interleave"
BUCKET_ROWS = 50_000
"""About how many rows of one bucket a task puts in order."""
COPY_CHUNK = 1_000
"""Copies of one row that one task writes out again at once."""
OVERHEAD = 16
_DRAW_BITS = 52
_KEY = ["_stratum", "doc_id", "size", "text_crc32"]


def _random(*parts: Column) -> Column:
    """52 bits of a digest of the parts."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, _DRAW_BITS // 4), 16, 10).cast("long")


def described() -> list[Column]:
    """The columns ``_KEY`` of a row; a null source is a stratum of its own, a null text empty."""
    text = F.coalesce("text", F.lit(""))
    return [
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_stratum"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ]


def _before(rows: DataFrame, by: list[str], bucket: str, weight: Column) -> DataFrame:
    """Per group and bucket the weight in the group's buckets before (``_before``) and in all of them (``_all``)."""
    counts = rows.groupBy(*by, bucket).agg(F.sum(weight).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counted = counts.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_all": F.sum("_n").over(Window.partitionBy(*by))})
    return counted.drop("_n")


def shard_plan(documents: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(_stratum, doc_id, size, text_crc32, copy, law, shard, slot, grown_shard): one row per row of ``documents``.

    ``size`` is the UTF-8 length of the text plus 16, ``slot`` the place in the shard, gapless from 0; ``copy`` numbers rows
    that agree in source, id, size and checksum. Null ids and sources are values like others, a null text is empty (checksum 0), very
    long texts are read once to be measured, and an empty table gives no rows. Reruns agree; which of the rows that
    agree in all four takes which place is open. Only doc_id, text and source are read. ``grown_shard`` is null, as a further shard moves rows.
    """
    groups = documents.select(*described()).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_copies"))
    draw = _random(F.lit(seed), *[F.col(c) for c in _KEY])
    groups = materialize(groups.withColumn("_draw", draw), "shard-groups")
    total = groups.agg(F.sum("_copies")).first()[0] or 0
    bits = max(total // BUCKET_ROWS, 1).bit_length()

    # Rank within the stratum, of the first of each group of copies.
    groups = groups.withColumn("_bucket", F.shiftright("_draw", _DRAW_BITS - bits))
    offsets = _before(groups, ["_stratum"], "_bucket", F.col("_copies"))
    inside = Window.partitionBy("_stratum", "_bucket").orderBy("_draw", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = groups.join(offsets, ["_stratum", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.coalesce(F.sum("_copies").over(inside), F.lit(0)))

    # A large group of copies is dealt out in chunks before it is spread into rows.
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {COPY_CHUNK}")))
    dealt = ranked.select(*_KEY, "_draw", "_copies", "_rank", "_all", chunks.alias("_chunk")).repartition("_stratum", "_draw", "_chunk")
    first, last = F.col("_chunk") * COPY_CHUNK, F.least((F.col("_chunk") + 1) * COPY_CHUNK, F.col("_copies")) - 1
    rows = dealt.select(*_KEY, "_rank", "_all", F.explode(F.sequence(first, last)).alias("copy")).withColumn("_rank", F.col("_rank") + F.col("copy"))
    offset = _random(F.lit(seed), F.col("_stratum")) / F.lit(float(1 << _DRAW_BITS))
    rows = rows.withColumn("_at", (F.col("_rank").cast("double") + offset) / F.col("_all").cast("double")).drop("_all")
    rows = materialize(rows.withColumn("_bucket", F.least(F.floor(F.col("_at") * (1 << bits)), F.lit((1 << bits) - 1))), "shard-fractions")

    # Rank in the whole table.
    order = Window.partitionBy("_bucket").orderBy("_at", "_stratum", "_rank")
    placed = rows.join(_before(rows, [], "_bucket", F.lit(1)).drop("_all"), "_bucket")
    place = F.col("_before") + F.row_number().over(order) - 1
    placed = placed.withColumn("_place", place).withColumn("shard", F.expr(f"_place * {shards} div {max(total, 1)}"))
    return placed.select(
        *_KEY,
        "copy",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.expr(f"_place - (shard * {total} + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(documents: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Every row of ``documents`` with all its columns, and ``shard`` and ``slot``; input columns of these names are replaced.

    The documents are written once with the task that read them, so that rows that agree in source, id, size and checksum are
    numbered task by task, never all in one.
    """
    documents = documents.drop("shard", "slot")
    own = [F.col(f"`{c}`").alias(f"_own_{k}") for k, c in enumerate(documents.columns)]
    tagged = documents.select(*own, *described()).withColumn("_task", F.spark_partition_id())
    tagged = materialize(tagged, "shard-documents")
    by_task = _before(tagged, _KEY, "_task", F.lit(1)).drop("_all").withColumnsRenamed({k: f"_in_{k}" for k in (*_KEY, "_task")})
    number = Window.partitionBy(*_KEY, "_task").orderBy(F.lit(0))
    counted = tagged.join(by_task, [F.col(k).eqNullSafe(F.col(f"_in_{k}")) for k in (*_KEY, "_task")])
    counted = counted.withColumn("_copy", F.col("_before") + F.row_number().over(number) - 1)
    plan = shard_plan(documents, shards, seed).select(*[F.col(k).alias(f"_plan_{k}") for k in _KEY], "copy", "shard", "slot")
    found = [F.col(k).eqNullSafe(F.col(f"_plan_{k}")) for k in _KEY]
    joined = counted.join(plan, [*found, F.col("_copy") == F.col("copy")])
    return joined.select(*[F.col(f"_own_{k}").alias(c) for k, c in enumerate(documents.columns)], "shard", "slot")


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, seed: str = SEED) -> None:
    """The documents as Parquet, one folder ``shard=k`` per shard, in the order of ``slot`` inside every file."""
    placed = shard_documents(documents, shards, seed).repartitionByRange("shard", "slot")
    placed.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def op13_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = shard_plan(documents_of(spark, sf_dir).select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


OP13_SQL = f"""
WITH t AS MATERIALIZED (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tab
  FROM (SELECT unnest(range(0, 256)) AS i)),
d AS (
  SELECT doc_id, coalesce('=' || source, '') AS stratum, octet_length(encode(coalesce(text, '')))::BIGINT + {OVERHEAD} AS size,
    xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
      lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295)) AS text_crc32
  FROM documents, t),
drawn AS (
  SELECT *, ('0x' || substr(md5('{SEED}:' || stratum || ':' || coalesce(doc_id::VARCHAR, '') || ':' || size || ':' || text_crc32), 1, 13))::BIGINT AS draw
  FROM d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY draw, doc_id NULLS FIRST, size, text_crc32) - 1 AS r, count(*) OVER (PARTITION BY stratum) AS n
  FROM drawn),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r::DOUBLE + ('0x' || substr(md5('{SEED}:' || stratum), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE) / n::DOUBLE, stratum, r) - 1 AS p,
    count(*) OVER () AS total
  FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p * {SHARDS} // total)::INT AS shard,
  (p - (p * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
"""
