"""Exact medians and grouped quantiles without gathering a column or a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import ROUND_FLOOR, ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.functions.numeric import RATIO_TYPE

SKETCH_ACCURACY = 10_000
# Half-width of the bracket, in units of the sketch's error bound.
BRACKET_ERRORS = 10
# Distinct values that may be left in a bracket when they are counted one by one.
FEW_VALUES = 10_000


@dataclass
class _Search:
    """The middle ranks of one column and the bracket, both ends included, that is known to hold them."""

    column: str
    unit: Decimal
    low: Decimal
    high: Decimal
    ranks: tuple[int, int]
    guess: tuple[Decimal, Decimal] | None
    middle: Decimal | None = None

    def cuts(self) -> tuple[Decimal, Decimal]:
        """Where the next pass counts: at the sketch's guess once, then at the bracket's halves."""
        if self.guess is not None:
            return max(self.guess[0], self.low), min(self.guess[1], self.high)
        half = ((self.low + self.high) / 2).quantize(self.unit, ROUND_FLOOR)
        return self.low, half

    def narrow(self, cuts: tuple[Decimal, Decimal], below: int, inside: int) -> None:
        """Keep the part of the bracket that holds the lower middle rank; see ``exact_medians`` for the upper one."""
        first, last = cuts
        if self.ranks[0] <= below:
            self.high = first - self.unit
        elif self.ranks[0] > below + inside:
            self.low = last + self.unit
        else:
            self.low, self.high = first, last
        self.guess = None


def exact_medians(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row with the interpolated median of each decimal column (``{column: name}``); NULLs are ignored.

    A mergeable rank sketch guesses a narrow bracket around the middle, and a second pass counts the rows below and inside
    it, for all columns at once. What the bracket holds is counted by value if it is few values, and halved otherwise, or
    where the guess missed, so the result is exact for any decimals. No window and no task sees the whole column; the jobs
    run when this is called, so ``df`` should be a written table.
    """
    margin = BRACKET_ERRORS / SKETCH_ACCURACY
    scales = {}
    for name in columns:
        kind = df.schema[name].dataType
        scales[name] = kind.scale if isinstance(kind, T.DecimalType) else 6
    values = df.select(*[F.col(c) if isinstance(df.schema[c].dataType, T.DecimalType) else F.col(c).cast(RATIO_TYPE).alias(c) for c in columns])
    kinds = {c: values.schema[c].dataType for c in columns}

    def known(c: str) -> list:
        ends = F.percentile_approx(c, [0.5 - margin, 0.5 + margin], SKETCH_ACCURACY)
        return [F.count(c).alias(f"{c}:n"), F.min(c).alias(f"{c}:low"), F.max(c).alias(f"{c}:high"), ends.alias(f"{c}:ends")]

    first = values.agg(*[x for c in columns for x in known(c)]).first()
    searches = []
    for c in columns:
        total = first[f"{c}:n"]
        if total:
            ends = first[f"{c}:ends"]
            ranks = ((total + 1) // 2, total // 2 + 1)
            searches.append(_Search(c, Decimal(1).scaleb(-scales[c]), first[f"{c}:low"], first[f"{c}:high"], ranks, (ends[0], ends[1])))

    with localcontext() as context:
        context.prec = 60
        open_ = searches
        while open_:
            counts = []
            for s in open_:
                low, high = (F.lit(x).cast(kinds[s.column]) for x in s.cuts())
                inside = F.col(s.column).between(low, high)
                counts += [F.count_if(F.col(s.column) < low), F.count_if(inside), F.approx_count_distinct(F.when(inside, F.col(s.column)))]
            row = values.agg(*[x.alias(f"x{k}") for k, x in enumerate(counts)]).first()
            for k, s in enumerate(open_):
                cuts, (below, inside, distinct) = s.cuts(), row[3 * k : 3 * k + 3]
                s.narrow(cuts, below, inside)
                held = below < s.ranks[0] <= below + inside
                if s.low == s.high or (held and distinct <= FEW_VALUES):
                    s.middle = _middle(values, s, kinds[s.column])
            open_ = [s for s in open_ if s.middle is None]

        found = {s.column: s.middle.quantize(Decimal("0.000001"), ROUND_HALF_UP) for s in searches}
    schema = ", ".join(f"{name} {RATIO_TYPE}" for name in columns.values())
    return df.sparkSession.createDataFrame([tuple(found.get(c) for c in columns)], schema)


def _middle(values: DataFrame, search: _Search, kind: T.DataType) -> Decimal:
    """The median, from the counts of the values in the bracket and of the one value above it."""
    column = F.col(search.column)
    low, high = (F.lit(x).cast(kind) for x in (search.low, search.high))
    around = values.agg(F.count_if(column < low).alias("below"), F.min(F.when(column > high, column)).alias("above")).first()
    counted = values.where(column.between(low, high)).groupBy(search.column).count().collect()  # about FEW_VALUES rows
    found, seen = [], around["below"]
    for row in sorted(counted, key=lambda r: r[0]):
        found += [row[0] for rank in search.ranks if seen < rank <= seen + row["count"]]
        seen += row["count"]
    # Of an even number of rows the upper middle one may be the first above the bracket.
    found += [around["above"]] * (2 - len(found))
    return (found[0] + found[1]) / 2


def exact_median(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row with the interpolated median of one column, see ``exact_medians``."""
    return exact_medians(df, {column: name})


SMALL_GROUP = 10 * SKETCH_ACCURACY // BRACKET_ERRORS
"""Groups of up to so many rows are ranked whole; in larger ones a bracket's margin is more than a rank."""


def exact_quantiles(df: DataFrame, by: Sequence[str], column: str, quantiles: Mapping[str, str], digits: int = 6) -> DataFrame:
    """Per group the rows (``n``) and interpolated quantiles (``{name: "0.25"}``) of a decimal or integer column; NULLs are ignored.

    A mergeable rank sketch per group brackets every quantile, with a margin of several times the sketch's error bound. One more pass
    counts, for all groups and quantiles at once, the rows below the bracket and those on each value inside it, and ranks the
    latter: about a five-hundredth of a large group's rows. So no state holds a group's values, and no task a group. The result is
    exact, rounded once (halves away from zero) to ``digits``. A group without values is left out.
    """
    kind = df.schema[column].dataType
    exact = kind if isinstance(kind, T.DecimalType) else T.DecimalType(28, 0)
    value = F.col(column).cast(exact)
    rows = df.where(F.col(column).isNotNull()).select(*by, value.alias("_value"))
    shares = [Decimal(q) for q in quantiles.values()]
    margin = Decimal(BRACKET_ERRORS) / SKETCH_ACCURACY
    cuts = [float(c) for q in shares for c in (max(q - margin, Decimal(0)), min(q + margin, Decimal(1)))]
    known = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.min("_value").alias("_min"), F.max("_value").alias("_max"), F.percentile_approx("_value", cuts, SKETCH_ACCURACY).alias("_cuts")
    )
    # Ranks from 0: the position (n - 1) * q in units of 10^-places, its floor, and the fraction after it.
    places = max([0, *(-int(q.as_tuple().exponent) for q in shares)])
    unit = 10**places
    asked = []
    for k, (name, q) in enumerate(zip(quantiles, shares, strict=True)):
        position = (F.col("n") - 1) * F.lit(int(q * unit))
        small = F.col("n") <= SMALL_GROUP
        low = F.when(small, F.col("_min")).otherwise(F.col("_cuts")[2 * k])
        high = F.when(small, F.col("_max")).otherwise(F.col("_cuts")[2 * k + 1])
        rank = F.call_function("div", position, F.lit(unit))
        asked.append(F.struct(F.lit(name).alias("name"), low.alias("low"), high.alias("high"), rank.alias("rank"), (position % unit).alias("part")))
    known = known.select(*by, "n", F.explode(F.array(*asked)).alias("q"))
    keys = {c: f"_by_{c}" for c in by}
    brackets = known.groupBy(*by).agg(F.collect_list("q").alias("_asked")).withColumnsRenamed(keys)  # one struct per quantile
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    # Rows above a bracket go, and each task adds those below it up before the shuffle.
    met = rows.join(brackets, same).select(*by, "_value", F.explode("_asked").alias("q")).where("_value <= q.high")
    below = F.col("_value") < F.col("q.low")
    counted = met.groupBy(*by, F.col("q.name").alias("name"), F.when(~below, F.col("_value")).alias("_value")).agg(F.count("*").alias("_rows"))
    # The rows below have no value and come first.
    upto = Window.partitionBy(*by, "name").orderBy(F.asc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("_rows").over(upto)).withColumnsRenamed({**keys, "name": "_name"})
    both = known.select(*by, "n", "q.*").join(ranked, [*same, F.col("name") == F.col("_name")])
    first = F.min(F.when(F.col("_upto") > F.col("rank"), F.col("_value")))
    second = F.min(F.when(F.col("_upto") > F.col("rank") + 1, F.col("_value")))
    found = both.groupBy(*by, "n", "name", "part").agg(first.alias("_first"), second.alias("_second"))
    step = (F.coalesce("_second", "_first") - F.col("_first")).cast(T.DecimalType(28, exact.scale)) * F.col("part").cast(f"decimal({places + 1},0)")
    scaled = F.col("_first").cast(T.DecimalType(28, exact.scale)) * F.lit(unit).cast(f"decimal({places + 1},0)") + step
    # One division by a power of ten, hence exact, and one rounding.
    quantile = F.round(scaled / F.lit(unit).cast(f"decimal({places + 1},0)"), digits).cast(f"decimal(28,{digits})")
    return found.groupBy(*by, "n").agg(*[F.max(F.when(F.col("name") == name, quantile)).alias(name) for name in quantiles])
