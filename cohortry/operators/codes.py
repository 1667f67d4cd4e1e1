"""Code-range mapping by an interval index, and wide-to-long code columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.session import materialize

INDEX_BYTES = 8 * 1024 * 1024
"""Interval ends up to this size are broadcast as one sorted array; larger sets are swept by range partition."""


def _interval(low: str, high: str, include_subcodes: bool) -> tuple[Column, Column]:
    """The range as bytes, first one inside and first one after: every code is a point between."""
    # No code lies between a code and the same one followed by a zero byte, and UTF-8 has no byte 255: the
    # codes that continue ``high`` are those up to ``high`` followed by one.
    after = F.unhex(F.lit("00"))
    if include_subcodes:
        after = F.when(F.col(high) != "", F.unhex(F.lit("FF"))).otherwise(after)
    return F.encode(F.col(low), "UTF-8"), F.concat(F.encode(F.col(high), "UTF-8"), after)


def _searched(df: DataFrame, value: Column, name: str, ends: DataFrame, bits: int) -> DataFrame:
    """``df`` with the number of ends up to ``value``: a binary search in the one-row table ``ends`` (``_ends``, sorted)."""

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get("_ends", at + width - 1) <= F.col("_value"), at + width).otherwise(at)

    widths = F.array(*[F.lit(1 << k) for k in reversed(range(bits))])
    found = df.withColumn("_value", value).crossJoin(F.broadcast(ends))
    # Behind the filter the searched value is a column, not an expression that each step computes anew.
    return found.where("_value is not null").withColumn(name, F.aggregate(widths, F.lit(0), step)).drop("_value", "_ends")


def _swept(values: DataFrame, ends: DataFrame) -> DataFrame:
    """(_value, _at): the number of ends up to each of the distinct ``values``, ends included.

    Ends and values are dealt out by range and sorted together, and each partition counts its ends; the counts of the
    partitions before are added. A densely asked interval spans partitions like any other stretch of values.
    """
    both = values.select("_value", F.lit(0).alias("_end")).unionByName(ends.select("_value", F.lit(1).alias("_end")))
    both = both.groupBy("_value").agg(F.max("_end").alias("_end"))
    dealt = materialize(both.repartitionByRange("_value").withColumn("_part", F.spark_partition_id()), "range-sweep")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    before = dealt.groupBy("_part").agg(F.sum("_end").alias("n")).withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    return dealt.join(before, "_part").select("_value", (F.col("_before") + F.sum("_end").over(inside)).cast("int").alias("_at"))


def code_range_join(
    rows: DataFrame, ranges: DataFrame, code: str, low: str = "low_code", high: str = "high_code",
    include_subcodes: bool = False, index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """Inner join of coded rows with lexicographic code ranges.

    The ends of all ranges cut the codes into elementary intervals, numbered in order. A range is a run of them and becomes the few
    aligned blocks (halves, quarters, ...) that make up that run; a code lies in one interval, hence in one block of each width. So
    the join is an equality on width and block: every pair it forms is a result, however the ranges overlap, and a
    range is listed a number of times that grows with the logarithm of their number.

    A code's interval is found by binary search in a broadcast array of the ends, whose size is counted first; above
    ``index_bytes`` by a sweep over the distinct codes and the ends in sorted partitions. NULL codes and ends match nothing.
    """
    spark = rows.sparkSession
    first, after = _interval(low, high, include_subcodes)
    cut = ranges.withColumns({"_first": first, "_after": after}).where(F.col("_first") < F.col("_after"))
    ends = cut.select(F.explode(F.array("_first", "_after")).alias("_value")).distinct()
    size = ends.agg(F.count("*").alias("n"), F.sum(F.octet_length("_value") + 16).alias("bytes")).first()
    levels = size["n"].bit_length()
    if (size["bytes"] or 0) <= index_bytes:
        sorted_ends = ends.agg(F.array_sort(F.collect_list("_value")).alias("_ends"))  # one row of at most index_bytes
        coded = _searched(rows, F.encode(F.col(code), "UTF-8"), "_at", sorted_ends, max(levels, 1))
        cut = _searched(cut, F.col("_first"), "_from", sorted_ends, max(levels, 1))
        cut = _searched(cut, F.col("_after"), "_to", sorted_ends, max(levels, 1))
    else:
        asked = rows.select(F.encode(F.col(code), "UTF-8").alias("_value")).where("_value is not null").distinct()
        places = materialize(_swept(asked, ends), "range-places")
        coded = rows.withColumn("_value", F.encode(F.col(code), "UTF-8")).join(places, "_value").drop("_value")
        cut = cut.join(places.withColumnsRenamed({"_value": "_first", "_at": "_from"}), "_first")
        cut = cut.join(places.withColumnsRenamed({"_value": "_after", "_at": "_to"}), "_after")

    # At each width the run's ends, rounded inwards; an odd one is a block of its own there.
    width = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level")
    cut = cut.select("*", width).withColumns({
        "_from": F.expr("shiftright(_from + shiftleft(1, _level) - 1, _level)"), "_to": F.expr("shiftright(_to, _level)"),
    })
    left = F.when((F.col("_from") < F.col("_to")) & (F.col("_from") % 2 == 1), F.col("_from"))
    right = F.when((F.col("_from") < F.col("_to")) & (F.col("_to") % 2 == 1), F.col("_to") - 1)
    blocks = cut.withColumn("_block", F.explode(F.array_compact(F.array(left, right)))).select(*ranges.columns, "_level", "_block")
    blocks = materialize(blocks, "range-blocks")
    used = sorted(r["_level"] for r in blocks.select("_level").distinct().collect())  # at most the logarithm of the ranges
    if not used:
        return spark.createDataFrame([], coded.drop("_at").join(ranges).schema)
    blocks_of = F.explode(F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright("_at", k).alias("_block")) for k in used])).alias("_asked")
    asked = coded.select("*", blocks_of).select(*coded.columns, "_asked.*")
    return asked.join(blocks, ["_level", "_block"]).select(*rows.columns, *ranges.columns)


def wide_codes_to_long(wide: DataFrame, ids: list[str], code_columns: list[str]) -> DataFrame:
    """One row per non-empty code column, with the column's position. A single map-side pass."""
    long = wide.unpivot(ids, code_columns, "code_column", "code")
    return long.where(F.col("code").isNotNull() & (F.col("code") != ""))
