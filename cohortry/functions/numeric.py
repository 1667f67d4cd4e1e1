"""Exact ratios. Sums of decimals do not depend on row order, so results are equal at any partitioning."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_TYPE = "decimal(28,6)"


def ratio(numerator: Column, denominator: Column, digits: int, half_even: bool = False) -> Column:
    """``numerator / denominator`` rounded once, halves away from zero or to the even digit; NULL for a zero denominator.

    Both sides are exact to six digits. The quotient is an integer division in units of the last digit kept, so
    no intermediate rounding can move a value onto a half. At most six digits are kept.
    """
    above, below = numerator.cast(RATIO_TYPE), denominator.cast(RATIO_TYPE)
    doubled = F.abs(above) * F.lit(2 * 10**digits).cast("decimal(7,0)") + F.abs(below)
    twice = F.nullif(F.abs(below), F.lit(0).cast(RATIO_TYPE)) * F.lit(2).cast("decimal(1,0)")
    steps = F.call_function("div", doubled, twice)
    if half_even:
        # An exact half was rounded up; the digit below it is the even one if that gave an odd digit.
        half = (doubled % twice == 0) & (steps % 2 == 1)
        steps = steps - F.when(half, 1).otherwise(0)
    signed = F.when((above < 0) != (below < 0), -steps).otherwise(steps).cast("decimal(19,0)")
    unit = F.lit(Decimal(1).scaleb(-digits)).cast(f"decimal({max(digits, 1)},{digits})")
    return (signed * unit).cast(f"decimal({min(23 + digits, 28)},{digits})")


def mean(value: Column | str, digits: int) -> Column:
    """Rounded average of a decimal or integer column as exact sum over count."""
    column = F.col(value) if isinstance(value, str) else value
    return ratio(F.sum(column).cast("decimal(30,6)"), F.count(column), digits)


def percent(condition: Column) -> Column:
    """Share of rows that meet ``condition``, unrounded."""
    hits = F.count_if(condition).cast("double") * F.lit(100.0)
    return hits / F.nullif(F.count("*"), F.lit(0)).cast("double")
