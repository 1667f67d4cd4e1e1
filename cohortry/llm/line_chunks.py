"""Line dedup: content-defined chunks of lines, of which global repeats are removed after byte comparison.

A text is cut into chunks of lines ``SETS`` times. In each boundary set a cut hangs on the hash of one line alone, after the
line by its 'end' digit or before it by its 'start' digit, so boundaries survive any change elsewhere and the edges of a
passage are found whatever surrounds it. A chunk counts as multi-line if at least two of its lines hold a word. A line
goes if a multi-line chunk of any set covers it that also stands at an earlier place (smaller document id, or earlier in
the document). The line stands there too, so the earliest place of every line keeps it.

A chunk can only repeat if each of its lines does. So single lines are counted first, and there the lines of one hash are
compared byte by byte: where they differ, none of them counts as repeated. From then on a hash stands for its line, and documents
are what is left of them: their repeated lines, each with its neighbours' hashes, which tell where chunks start and end.
Chunks are equal if their sequences of lines are. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.base import documents_of, shielded
from cohortry.session import materialize

SETS = 16
"""Boundary sets, at most 16: each has two digits of a line's hash of its own."""
CUT_DIGIT = "4"
"""A line starts (or ends) a chunk of a set where its digit is not above this: five of sixteen."""
_IN_WORD = "[^\\x20\\x09-\\x0D]"


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long")


def _lines(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, hash, last, next, blank): every line with the hashes of the lines around it.

    ``blank`` has the bytes of a line without a word and is null for others.
    """
    split = F.transform(F.split("text", "\n", -1), lambda x: F.struct(_line_hash(x).alias("hash"), F.when(~x.rlike(_IN_WORD), F.lower(F.hex(x))).alias("blank")))
    # Behind a generator the parts are a column that lambdas read, not an expression computed anew for each element.
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_key"), F.explode(F.array(split)).alias("parts"))
    near = F.transform(
        "parts",
        lambda p, i: F.struct(p["hash"].alias("hash"), F.get("parts", i - 1)["hash"].alias("last"), F.get("parts", i + 1)["hash"].alias("next"), p["blank"].alias("blank")),
    )
    return rows.select("doc_id", "text_key", F.posexplode(near).alias("pos", "line")).select("doc_id", "text_key", "pos", "line.*")


def _repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, parts): per document its lines that stand in more than one place, in order; wordless lines always stay."""
    # The lines of one hash are compared where they are counted; those of a task are reduced to one before the shuffle.
    every = documents.select(F.explode(F.split("text", "\n", -1)).alias("line")).where(F.col("line").rlike(_IN_WORD))
    counted = every.groupBy(_line_hash(F.col("line")).alias("hash")).agg(F.count(F.lit(1)).alias("many"), F.min("line").alias("low"), F.max("line").alias("high"))
    often = materialize(counted.where("many > 1 AND low = high").select("hash"), "line-hashes")
    lines = _lines(documents)
    found = lines.where("blank IS NULL").join(often, "hash").select(*lines.columns).unionByName(lines.where("blank IS NOT NULL"))
    # Rows equal in id and text are one document, hence a set.
    parts = F.collect_set(F.struct("pos", "hash", "last", "next", "blank"))
    grouped = found.groupBy("doc_id", "text_key").agg(F.sort_array(parts).alias("parts"), F.count_if(F.col("blank").isNull()).alias("n_worded"))
    return grouped.where("n_worded > 1").drop("n_worded")


def _runs(parts: DataFrame) -> DataFrame:
    """(place, run_hash, run): the multi-line chunks of all boundary sets that have repeated lines only, each place once.

    ``place`` is (doc_id, text_key, at, n), the first line and the number of lines; ``run`` is the sequence of lines.
    """

    def digits(h):
        return F.md5(h.cast("string").cast("binary"))

    known = F.transform("parts", lambda p: F.struct(p.alias("p"), digits(p["hash"]).alias("own"), digits(p["last"]).alias("last"), digits(p["next"]).alias("next")))
    rows = parts.select("doc_id", "text_key", F.explode(F.array(known)).alias("lines"))

    def low(digest, at):
        return F.substring(digest, at, 1) <= CUT_DIGIT

    def token(k):
        def of_line(x, i):
            starts = x["last"].isNull() | low(x["own"], k + 1) | low(x["last"], k + 17)
            ends = x["next"].isNull() | low(x["next"], k + 1) | low(x["own"], k + 17)
            gap = F.coalesce(F.get("lines", i - 1)["p"]["pos"] != x["p"]["pos"] - 1, F.lit(False))
            mark = F.when(starts, "\nS").when(gap, "\n").otherwise("")
            own = F.coalesce(F.concat(F.lit("b"), x["p"]["blank"]), F.concat(F.lit("w"), x["p"]["hash"].cast("string")))
            line = F.concat(x["p"]["pos"].cast("string"), F.lit(":"), own)
            return F.concat(mark, line, F.when(ends, "E ").otherwise(" "))

        return of_line

    # A chunk is whole where it begins with the line that starts it and ends with the one that ends it.
    every = F.flatten(F.array(*(F.split(F.array_join(F.transform("lines", token(k)), ""), "\n", -1) for k in range(SETS))))
    whole = F.filter(every, lambda c: c.startswith("S") & c.endswith("E ") & (F.length(c) - F.length(F.replace(c, F.lit("w"), F.lit(""))) > 1))
    found = rows.select("doc_id", "text_key", F.explode(F.array_distinct(F.transform(whole, lambda c: F.translate(c, "SE", "")))).alias("run"))
    at = F.substring_index("run", ":", 1).cast("int").alias("at")
    n = (F.length("run") - F.length(F.replace("run", F.lit(":"), F.lit("")))).alias("n")
    sequence = F.regexp_replace("run", "\\d+:", "")
    return found.select(F.struct("doc_id", "text_key", at, n).alias("place"), F.xxhash64(sequence).alias("run_hash"), sequence.alias("run"))


def repeated_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, runs): per document the chunks (at, n) of any boundary set that an earlier document or place has.

    Rows that are equal in id and text count as one document; a null id comes before all others.
    """
    runs = _runs(materialize(_repeated_lines(documents), "repeated-lines"))
    first = runs.groupBy("run_hash", "run").agg(F.count(F.lit(1)).alias("many"), F.min("place").alias("first")).where("many > 1").drop("many")
    later = runs.join(materialize(first, "first-places"), ["run_hash", "run"]).where(F.col("place") != F.col("first"))
    return later.groupBy("place.doc_id", "place.text_key").agg(F.collect_set(F.struct("place.at", "place.n")).alias("runs"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with shortened texts, and ``n_lines`` (of the whole text) and ``n_removed`` (lines) after its columns.

    Null texts stay null (0 lines), an empty text is one line without a word, a text of which every line goes becomes empty,
    rows equal in id and text are treated alike and do not count as repeats of one another, an empty table gives no
    rows, a text's work grows with its lines. Input columns of the new names are replaced.
    """
    documents, restored = shielded(documents.drop("n_lines", "n_removed"), "doc_id", "text")
    runs = materialize(repeated_runs(documents), "removed-runs").select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_key"), "runs")
    # Documents are dealt out by id at every size; a broadcast of the list would only fit small corpora.
    joined = documents.withColumn("_text_key", F.xxhash64("text")).join(
        runs.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_text_key") == F.col("_key")), "left"
    )
    cut = joined.withColumn("_lines", F.explode(F.array(F.split("text", "\n", -1))))
    gone = F.flatten(F.transform("runs", lambda r: F.sequence(r["at"], r["at"] + r["n"] - 1)))
    kept = cut.withColumn("_kept", F.explode(F.array(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone))))
    text = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n"))
    own = [text.alias(c) if c == "text" else F.col(c) for c in documents.columns]
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long")
    n_removed = F.when(F.col("runs").isNull(), 0).otherwise(F.size("_lines") - F.size("_kept")).cast("long")
    return restored(kept.select(*own, n_lines.alias("n_lines"), n_removed.alias("n_removed")))


def dedup_document_lines(documents: DataFrame) -> DataFrame:
    """The rows and columns of ``documents``, with the texts of ``dedup_lines`` and ``n_chars`` to match."""
    inner, restored = shielded(documents, "doc_id", "text", "n_chars")
    done = dedup_lines(inner).drop("n_lines", "n_removed")
    return restored(done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in done.columns else done)


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents_of(spark, sf_dir).select("doc_id", "text"))


OP10_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
hashed AS (SELECT *, md5((('0x' || substr(md5(line), 1, 15))::BIGINT)::VARCHAR) AS own FROM lines),
beside AS (SELECT *, lag(own) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM hashed),
marked AS (
  SELECT b.*, k, substr(own, (k + 1)::INT, 1) <= '{CUT_DIGIT}' OR coalesce(substr(last, (k + 17)::INT, 1) <= '{CUT_DIGIT}', false) AS cut
  FROM beside b, range({SETS}) AS sets(k)),
placed AS (SELECT *, sum(cut::INT) OVER (PARTITION BY doc_id, k ORDER BY i) AS pos FROM marked),
chunks AS (
  SELECT DISTINCT doc_id, top, n, chunk FROM (
    SELECT doc_id, k, pos, min(i) AS top, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk,
      count(*) FILTER (regexp_matches(line, '[^\\x20\\x09-\\x0D]')) > 1 AS multi
    FROM placed GROUP BY doc_id, k, pos) WHERE multi),
later AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, top) > 1 AS gone FROM chunks),
covered AS (SELECT DISTINCT doc_id, unnest(range(top, top + n)) AS i FROM later WHERE gone),
kept AS (SELECT l.*, c.i IS NULL AS stays FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.i = c.i)
SELECT d.doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), CASE WHEN d.text IS NOT NULL THEN '' END) AS text,
  count(k.i) AS n_lines, count(*) FILTER (NOT stays) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id GROUP BY d.doc_id, d.text
"""
