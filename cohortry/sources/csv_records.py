"""Headed CSV files as records of text, with a verdict on every record, in one pass over the files.

Spark reads the files as lines and splits large ones anywhere. Which lines continue a quoted field is found afterwards: seen alone, a
line leads from "outside quotes" and from "inside quotes" to one of the two, so a line is one of four functions (stay, swap, always
out, always in), and functions of neighbouring lines compose. A window per chunk of a file block composes them up to every line; one small
table, a row per chunk, composes the chunks; both together tell where each line starts. Lines that are a record of
their own go on as they are, the lines of longer records are put together within their chunk. So the text is shuffled once, in groups
far smaller than a task's memory; only records that run over the edge of a chunk are shuffled again.

Without line breaks in quotes (``quoted_newlines=False``) each line is a record and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SURPLUS = "(surplus fields)"
"""What the verdict names where a record has more fields than the header."""

# Java patterns over one line. A quoted field opens at the start of a field; a doubled quote stands for one.
_INNER = '[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:[^",][^,]*+)?+,|"{_INNER}"(?!")[^,]*+,)*+'
_OPENED = f'^{_FIELDS}"{_INNER}$'
_STILL_INSIDE = f"^{_INNER}$"
_CLOSED_AND_OPENED = f'^{_INNER}"(?!")[^,]*+,{_FIELDS}"{_INNER}$'
_QUOTED_FIELD = f'(^|,)"{_INNER}"(?!")'

CHUNK_BITS = 12
"""Lines of a block whose numbers agree but for so many low bits are a chunk."""


class SchemaError(ValueError):
    """Files whose header is not the one their table declares."""


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of the first file; reads no more than that."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def _lines(spark: SparkSession, path: str, where: Column | None) -> DataFrame:
    """(_file, _block, _chunk, _line, value) and the folders' partition columns; ``_line`` rises within a block of a file, ``_chunk`` with it.

    ``_file`` is a hash of the file's path, as it stands in every row.
    """
    # Only \\n ends a line, so a \\r\\n inside quotes is kept.
    read = spark.read.option("lineSep", "\n").text(path)
    read = read if where is None else read.where(where)
    file, block = F.xxhash64("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = read.select("*", file.alias("_file"), block.alias("_block"), F.monotonically_increasing_id().alias("_line"))
    return lines.withColumn("_chunk", F.shiftright("_line", CHUNK_BITS))


def _state(entered: Column | int, swaps: Column, fixed: Column) -> Column:
    """Whether quotes are open (1) after lines that swapped ``swaps`` times and last fixed the state as ``fixed`` tells."""
    moved = F.coalesce(swaps, F.lit(0))
    return F.pmod(F.when(fixed.isNull(), moved + entered).otherwise(fixed["to"] + moved - fixed["at"]), F.lit(2))


_CHUNK = ["_file", "_block", "_chunk"]


def _placed(lines: DataFrame) -> DataFrame:
    """``lines`` with ``_starts_inside`` and ``_ends_inside``, whether a quoted field is open there, and ``_head``, where their record began.

    ``_broken``: the record has lines in another chunk.
    """
    plain = ~F.contains("value", F.lit('"'))
    lines = lines.withColumns({
        "_out": ~plain & F.col("value").rlike(_OPENED),
        "_in": plain | F.col("value").rlike(_STILL_INSIDE) | F.col("value").rlike(_CLOSED_AND_OPENED),
    })
    # A line either fixes the state, whatever it was, or keeps or swaps it.
    place = F.struct("_block", "_line")
    chunk = Window.partitionBy(*_CHUNK)
    upto = chunk.orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    before = chunk.orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("_swaps", F.sum((F.col("_out") & ~F.col("_in")).cast("int")).over(upto))
    fixes = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").cast("int").alias("to"), F.col("_swaps").alias("at")))
    lines = lines.withColumns({
        "_fixed": F.last(fixes, ignorenulls=True).over(upto), "_fixed_before": F.last(fixes, ignorenulls=True).over(before), "_swaps_before": F.max("_swaps").over(before),
    })

    # One row per chunk: its function, and where its last record begins for either state at its start. (The text's empty prefix keeps
    # the text in this branch, so that it shares the other ones' exchange and the files are read once.)
    def last(entered: int) -> Column:
        return F.max(F.when(_state(entered, F.col("_swaps_before"), F.col("_fixed_before")) == 0, place))

    chunks = lines.groupBy(*_CHUNK).agg(
        F.max_by(F.struct("_swaps", "_fixed"), "_line").alias("all"), last(0).alias("last_out"), last(1).alias("last_in"),
        F.min("_line").alias("first"), F.max(F.length(F.left("value", F.lit(0)))).alias("none"),
    )
    chunks = chunks.select(*_CHUNK, "first", (F.col("all._swaps") + F.col("none")).alias("swaps"), F.col("all._fixed").alias("fixed"), "last_out", "last_in")
    earlier = Window.partitionBy("_file").orderBy("_block", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("total", F.coalesce(F.sum("swaps").over(earlier), F.lit(0)))
    fixed = F.when(F.col("fixed").isNotNull(), F.struct(F.col("fixed.to").alias("to"), (F.col("total") + F.col("fixed.at")).alias("at")))
    chunks = chunks.withColumn("_enters", _state(0, F.col("total"), F.last(fixed, ignorenulls=True).over(earlier)))
    began = F.when(F.col("_enters") == 0, F.col("last_out")).otherwise(F.col("last_in"))
    chunks = chunks.withColumns({
        "_came": F.last(began, ignorenulls=True).over(earlier),
        # The last record goes on in the next chunk if quotes are open at the end of this one.
        "_goes_on": F.when(_state(F.col("_enters"), F.col("swaps"), F.col("fixed")) == 1, began),
        "_top": F.when((F.col("_block") == 0) & (F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_chunk")) == 1), F.col("first")),
    }).select(*_CHUNK, "_enters", "_came", "_goes_on", "_top")

    lines = lines.join(chunks, _CHUNK).withColumns({
        "_starts_inside": _state(F.col("_enters"), F.col("_swaps_before"), F.col("_fixed_before")) == 1,
        "_ends_inside": _state(F.col("_enters"), F.col("_swaps"), F.col("_fixed")) == 1,
        "_is_header": F.col("_line").eqNullSafe(F.col("_top")),
    })
    begun = F.last(F.when(~F.col("_starts_inside"), place), ignorenulls=True).over(upto)
    lines = lines.withColumn("_begun", begun).withColumn("_broken", F.col("_begun").isNull() | F.col("_begun").eqNullSafe(F.col("_goes_on")))
    return lines.withColumn("_head", F.coalesce("_begun", "_came"))


def _records(lines: DataFrame, folders: list[str]) -> DataFrame:
    """(value, _is_header) and ``folders``, one row per record; the first record of a file is its header."""
    found = _placed(lines)
    single = found.where("not _starts_inside and not _ends_inside").select("value", "_is_header", *folders)
    parts = found.where("_starts_inside or _ends_inside")

    def whole(parts: DataFrame, *record: str) -> DataFrame:
        lines_of = F.sort_array(F.collect_list(F.struct("_block", "_line", "value")))  # the lines of one record
        return parts.groupBy(*record).agg(
            F.array_join(F.transform(lines_of, lambda x: x["value"]), "\n").alias("value"),
            F.bool_or("_is_header").alias("_is_header"),
            *[F.first(c).alias(c) for c in folders],
        ).drop(*record)

    # The first grouping is within chunks, as the lines lie.
    records = single.unionByName(whole(parts.where("not _broken"), *_CHUNK, "_head"))
    return records.unionByName(whole(parts.where("_broken"), "_file", "_head"))


def n_fields(record: Column) -> Column:
    """Fields of a record: separators outside quoted fields, and one."""
    bare = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, _QUOTED_FIELD, "$1")).otherwise(record)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, quoted_newlines: bool = True, where: Column | None = None
) -> DataFrame:
    """The records of a headed CSV file, folder or glob as text columns, with ``_record`` and ``_surplus`` after them.

    Declared columns come first and in their order, bound by the header's names, then undeclared ones and those that folders
    named ``column=value`` give. A missing declared column is an error, and so is a file with another header, once its rows
    are read. Short records end in NULLs; ``_surplus`` tells whether a record has more fields than the header, and then
    ``_record`` is its text. Blank lines are skipped. ``where`` filters on the folders' columns before a file is read.
    """
    names = header_of(spark, path)  # with the folders' columns
    missing = [name for name in schema.fieldNames() if name.lower() not in {n.lower() for n in names}]
    if missing:
        raise SchemaError(f"{path} has no column {', '.join(missing)}")
    if quoted_newlines:
        lines = _lines(spark, path, where)
        folders = [c for c in lines.columns if c not in ("value", "_line", *_CHUNK)]
        names = [n for n in names if n not in folders]
        records = _records(lines, folders).withColumn("_record", F.regexp_replace("value", "\r$", ""))
        records = records.where(F.trim("_record") != "")
        parsed = F.from_csv("_record", ", ".join(f"c{k} string" for k in range(len(names))), {"mode": "PERMISSIVE", "escape": '"'})
        records = records.withColumn("_fields", parsed)
        given = F.array(*[F.col(f"_fields.c{k}") for k in range(len(names))])
        other = F.raise_error(F.concat(F.lit("a file's header differs from the first one's: "), F.col("_record"))).cast("boolean")
        is_data = F.when(F.col("_is_header"), F.when(given == F.array(*[F.lit(n) for n in names]), False).otherwise(other)).otherwise(True)
        fields = [F.col(f"_fields.c{k}").alias(n) for k, n in enumerate(names)]
        text = records.where(is_data).select(*fields, *[_name(c) for c in folders], "_record")
    else:
        # Lines are records, so Spark's own reader splits the files; it keeps the text of records of another length.
        text = ", ".join(f"`{n}` string" for n in names)
        reader = spark.read.schema(f"{text}, _record string").option("header", True).option("enforceSchema", False)
        text = reader.option("columnNameOfCorruptRecord", "_record").option("escape", '"').csv(path)
        text = text if where is None else text.where(where)
        folders = []
    present = {name.lower(): name for name in (*names, *folders)}
    declared = {name.lower() for name in schema.fieldNames()}
    bound = [_name(present[name.lower()]).alias(name) for name in schema.fieldNames()]
    further = [_name(name) for name in present.values() if name.lower() not in declared]
    surplus = F.coalesce(n_fields(F.col("_record")) > len(names), F.lit(False))
    return text.select(*bound, *further, F.when(surplus, F.col("_record")).alias("_record"), surplus.alias("_surplus"))
