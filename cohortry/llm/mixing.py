"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words (its share of the weights, at most ``MOST`` times its size). Within it documents are
expected in unequal numbers of copies, in proportion to about the square root of their words (``inclusion``), at most
``MOST``, so that the expected words make the target. The whole copies among them are certain. What is left is the
inclusion probability p, and documents enter one copy more in the order of their random odds divided by their
inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, until the sample has the size that is missing, counted in words. The
document at which the target is crossed enters if that ends nearer.

Documents are never sorted as a whole: a histogram over the leading bits of the rank, then one over the next bits inside
the crossing bin, find the bin in which the target is crossed; only that bin's documents are ordered. ``u`` comes from a
digest of the row, so reruns agree at any partitioning. Rows equal in everything share a rank and a place; of those at
which the target is crossed just as many enter as come nearest to it, and it does not matter which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.base import documents_of, shielded
from cohortry.session import materialize

SHARE = 1.5
"""Words of the mix, as a multiple of all words."""
WEIGHTS = (5.0, 2.0, 1.0)
"""Weights of the sources in code-point order, repeating; a null source comes last."""
MOST = 2
"""A source is taken at most this many times."""
BITS, LEVELS = 10, 2
"""Bits of u per histogram level (``2 ** BITS`` bins per source), and levels before documents are ranked."""
WORD = "[^\\x20\\x09-\\x0D]+"
MOST_BROADCAST = 100_000
"""Plans of more rows (32 at most for a source) are joined without a broadcast."""
BLOCK = 4096
"""Rows of one group of equal rows that one task writes out at a time."""
_U_BITS = 52


def source_targets(sizes: list[tuple[str | None, int]], share: float = SHARE, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """Target words of each source: shares by weight, capped at ``most`` times the size, the excess reshared."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    total = share * sum(n for _, n in ordered)
    open_ = {i: weights[i % len(weights)] for i in range(len(ordered))}
    target = [0.0] * len(ordered)
    left = total
    while open_:
        unit = left / sum(open_.values())
        above = [i for i, w in open_.items() if w * unit > most * ordered[i][1]]
        if not above:
            for i, w in open_.items():
                target[i] = w * unit
            break
        for i in above:
            target[i] = float(most * ordered[i][1])
            left -= target[i]
            del open_[i]
    return {name: target[i] for i, (name, _) in enumerate(ordered)}


def inclusion(words: dict[int, int], target: float, most: float = MOST) -> dict[int, float]:
    """Expected copies of a document of each tier, given the tiers' words: in proportion to ``2 ** tier``, at most ``most``.

    They sum to ``target`` words. A tier holds the documents of ``4 ** tier`` words and more, below the next one's.
    """
    left, open_ = target, sorted((t for t, n in words.items() if n), reverse=True)
    copies = dict.fromkeys(words, 0.0)
    while open_:
        rate = left / sum(2.0**t * words[t] for t in open_)
        if rate * 2.0 ** open_[0] <= most:
            return copies | {t: rate * 2.0**t for t in open_}
        full = open_.pop(0)
        copies[full] = float(most)
        left -= most * words[full]
    return copies


def _crossing(bins: DataFrame) -> DataFrame:
    """Per source the first bin in which the summed words reach what is missing, and the words before it.

    A window holds at most ``2 ** BITS`` rows: the bins of one source. (Words are whole: half a word forgives rounding.)
    """
    order = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    reached = bins.withColumn("upto", F.sum("words").over(order)).where(F.col("upto") >= F.col("missing") - 0.5)
    first = reached.groupBy("source", "missing").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("at"))
    return first.select("source", F.col("at.bin").alias("bin"), (F.col("missing") - F.col("at.before")).alias("missing"))


def _joined(df: DataFrame, rows: list[tuple], schema: str, *on: str) -> DataFrame:
    """``df`` with the columns of a table of plan rows, joined by ``on``; broadcast up to a size that is checked."""
    other = df.sparkSession.createDataFrame(rows, schema).withColumnsRenamed({c: f"_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(F.broadcast(other) if len(rows) <= MOST_BROADCAST else other, same).drop(*(f"_{c}" for c in on))


def draw_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with ``size``, the words of the text, its ``tier``, and ``draw``, the 52 bits of its random number u."""
    # A null text is told from an empty one by a mark that comes first.
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.concat(F.lit("t"), "text"), F.lit("n"))]
    others = [c for c in documents.columns if c not in ("doc_id", "text", "source")]
    if others:
        parts.append(F.to_json(F.struct(*others)))
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    drawn = documents.withColumns({"size": size, "digest": F.md5(F.concat(*parts).cast("binary"))})
    tier = F.shiftright(F.length(F.bin("size")) - 1, 1)
    return drawn.withColumns({"tier": tier, "draw": F.conv(F.substring("digest", 1, _U_BITS // 4), 16, 10).cast("long")})


def _rank() -> Column:
    """The Pareto rank x of ``draw`` under the odds of ``p``, as x / (1 + x) in 52 bits; both order alike."""
    u, p = (F.col("draw") + 0.5) / float(1 << _U_BITS), F.col("p")
    above, below = u * (1 - p), (1 - u) * p
    return F.floor(above / (above + below) * float(1 << _U_BITS)).cast("long")


_PLAN = "source string, tier int, source_size long, target double, whole int, p double, cut long, cut_size long, n_equal long, n_enter long"


def plan_mix(drawn: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS) -> list[tuple]:
    """Rows (source, tier, source_size, target, whole, p, cut, cut_size, n_equal, n_enter), at most 32 for a source.

    ``whole`` copies are certain, one copy more goes to the rows that come before (``cut``, ``cut_size``) in the order of (rank,
    size), and to ``n_enter`` of the ``n_equal`` rows that stand just there.
    ``drawn`` needs ``source``, ``size``, ``tier`` and ``draw`` and is read four times. The number of sources must be moderate:
    their sizes by tier go to the driver, where the targets are found together.
    """
    words: dict[str | None, dict[int, int]] = {}
    for r in drawn.groupBy("source", "tier").agg(F.sum("size").alias("n")).collect():
        words.setdefault(r["source"], {})[r["tier"]] = int(r["n"])
    target = source_targets([(name, sum(tiers.values())) for name, tiers in words.items()], share, weights)
    copies = {(name, tier): n for name, tiers in words.items() for tier, n in inclusion(tiers, target[name]).items()}
    odds = [(name, tier, n - int(n)) for (name, tier), n in copies.items() if n > int(n)]
    gaps = [(name, target[name] - sum(int(copies[name, t]) * n for t, n in tiers.items())) for name, tiers in words.items()]
    gaps = [(name, gap) for name, gap in gaps if gap > 0]

    part = _joined(drawn.select("source", "size", "tier", "draw"), odds, "source string, tier int, p double", "source", "tier")
    part = part.select("source", "size", _rank().alias("rank"))
    shift = _U_BITS
    for _ in range(LEVELS):
        shift -= BITS
        binned = _joined(part, gaps, "source string, missing double", "source").withColumn("bin", F.shiftright("rank", shift))
        cross = _crossing(binned.groupBy("source", "missing", "bin").agg(F.sum("size").alias("words"))).collect()  # one row per source
        gaps = [(r["source"], r["missing"]) for r in cross]
        bins = _joined(part, [(r["source"], r["bin"]) for r in cross], "source string, bin long", "source")
        part = bins.where(F.shiftright("rank", shift) == F.col("bin")).drop("bin")

    order = Window.partitionBy("source").orderBy("rank", "size")
    ranked = _joined(part, gaps, "source string, missing double", "source").groupBy("source", "missing", "rank", "size")
    ranked = ranked.agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("words").over(order))
    before = F.col("upto") - F.col("words")
    # As many rows as end nearest to the target.
    enter = F.least(F.col("n"), F.greatest(F.lit(0), F.ceil((F.col("missing") - before) / F.col("size") - 0.5)))
    at = ranked.where((F.col("upto") >= F.col("missing") - 0.5) & (F.col("size") > 0)).groupBy("source")
    at = at.agg(F.min(F.struct("rank", "size", "n", enter.cast("long").alias("enter"))).alias("at")).select("source", "at.*")
    cut = {r["source"]: (r["rank"], r["size"], r["n"], r["enter"]) for r in at.collect()}  # one row per source
    return [
        (name, tier, sum(words[name].values()), round(target[name], 6), int(n), n - int(n), *cut.get(name, (-1, 0, 0, 0)))
        for (name, tier), n in copies.items()
    ]


def _mixed(documents: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``mix_sources`` of documents whose other columns are shielded."""
    drawn = draw_documents(documents)
    plan = plan_mix(materialize(drawn.select("source", "size", "tier", "draw"), "mix"), share, weights)
    mixed = _joined(drawn, plan, _PLAN, "source", "tier").withColumn("rank", F.when(F.col("p") > 0, _rank()))
    here = (F.col("rank") == F.col("cut")) & (F.col("size") == F.col("cut_size"))
    before = (F.col("rank") < F.col("cut")) | ((F.col("rank") == F.col("cut")) & (F.col("size") < F.col("cut_size")))
    some = here & (F.col("n_enter") > 0) & (F.col("n_enter") < F.col("n_equal"))
    enters = before | (here & (F.col("n_enter") == F.col("n_equal")))
    own = [*documents.columns, "size", "source_size", "target"]

    def finished(rows: DataFrame, more: Column) -> DataFrame:
        rows = rows.withColumn("copies", F.col("whole") + F.coalesce(more, F.lit(False)).cast("int"))
        return rows.select(*own, "copies", (F.col("size") * F.col("copies")).alias("taken"))

    if not any(0 < row[-1] < row[-2] for row in plan):
        return finished(mixed, enters)
    # Equal rows of which a part enters are counted, told apart by number and written out in blocks, by many tasks.
    kept = [c for c in (*own, "whole", "n_enter") if c not in ("source", "size")]
    equal = mixed.where(some).groupBy("source", "rank", "size", "digest").agg(*(F.first(c).alias(c) for c in kept), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    numbered = equal.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    blocks = numbered.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / BLOCK)))).repartition("start", "block")
    last = F.least(F.col("block") * BLOCK + BLOCK, F.col("n")) - 1
    single = blocks.select(*own, "whole", "n_enter", "start", F.explode(F.sequence(F.col("block") * BLOCK, last)).alias("at"))
    split = finished(single, F.col("start") + F.col("at") < F.col("n_enter"))
    return finished(mixed.where(~F.coalesce(some, F.lit(False))), enters).unionByName(split)


def mix_sources(documents: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Every row of ``documents`` with its columns, and ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Null texts have size 0; a null source is a source of its own, the last; a document without words takes 0 words; of rows
    that are equal in every column any may enter, but always as many; an empty table gives no rows. Input columns of the
    new names are replaced.
    """
    inner, restored = shielded(documents, "doc_id", "text", "source")
    mixed = _mixed(inner, share, weights)
    new = ("size", "source_size", "target", "copies", "taken")
    replaced = [own for own, c in zip(inner.columns, documents.columns) if c in new]
    return restored(mixed.drop(*replaced))


def take_mix(documents: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with its own columns, whatever their names."""
    inner, restored = shielded(documents, "doc_id", "text", "source")
    repeated = _mixed(inner).where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return restored(repeated.select(*inner.columns))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents_of(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, (length(bin(size)) - 1) // 2 AS tier,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce('t' || text, 'n')), 1, 13))::BIGINT AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
r AS (
  SELECT *, {MOST} * n AS most,
    coalesce(sum({MOST} * n) OVER before, 0)::DOUBLE AS capped, coalesce(sum(weight) OVER before, 0)::DOUBLE AS gone,
    sum(weight) OVER () AS weights, {SHARE} * sum(n) OVER () AS total
  FROM w WINDOW before AS (ORDER BY n / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (
  SELECT (total - capped) / (weights - gone) AS unit FROM r WHERE (total - capped) / (weights - gone) * weight <= most
  ORDER BY n / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, n AS source_size, least(most, weight * unit) AS goal FROM r, u),
k AS (SELECT source, tier, sum(size)::BIGINT AS words, pow(2.0, tier) AS measure FROM d GROUP BY source, tier),
f AS (
  SELECT k.*, t.source_size, t.goal,
    t.goal - coalesce(sum({MOST} * words) OVER (above ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS open,
    sum(measure * words) OVER (above ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS measures
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source WINDOW above AS (PARTITION BY k.source ORDER BY tier DESC)),
g AS (SELECT source, max_by(open / measures, tier) AS rate FROM f WHERE measures > 0 AND open / measures * measure <= {MOST} GROUP BY source),
i AS (SELECT f.*, least({MOST}, coalesce(g.rate * measure, {MOST})) AS expected FROM f LEFT JOIN g ON f.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, floor(expected) AS whole, expected - floor(expected) AS p, goal - sum(floor(expected) * words) OVER (PARTITION BY source) AS missing FROM i),
e AS (
  SELECT d.*, p.source_size, p.goal, p.whole, p.missing,
    CASE WHEN p > 0 THEN floor((uniform * (1 - p)) / (uniform * (1 - p) + (1 - uniform) * p) * {1 << _U_BITS})::BIGINT END AS rank
  FROM (SELECT *, (draw + 0.5::DOUBLE) / {1 << _U_BITS}::DOUBLE AS uniform FROM d) d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.tier = p.tier),
c AS (SELECT source, rank, size, any_value(missing) AS missing, sum(size) AS words, count(*) AS n FROM e WHERE rank IS NOT NULL GROUP BY source, rank, size),
o AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY rank, size) AS upto FROM c),
x AS (
  SELECT source, rank AS cut, size AS cut_size, greatest(0, ceil((missing - (upto - words)) / size - 0.5)) AS enter FROM o
  WHERE missing > 0 AND size > 0 AND upto >= missing - 0.5 QUALIFY row_number() OVER (PARTITION BY source ORDER BY rank, size) = 1),
z AS (
  SELECT e.*, CASE WHEN rank < cut OR (rank = cut AND size < cut_size) THEN 1 WHEN rank = cut AND size = cut_size
    AND row_number() OVER (PARTITION BY e.source, rank, size ORDER BY doc_id) <= enter THEN 1 ELSE 0 END AS more
  FROM e LEFT JOIN x ON e.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, source_size, round(goal, 6) AS target, (size * (whole + more))::BIGINT AS taken FROM z
"""
