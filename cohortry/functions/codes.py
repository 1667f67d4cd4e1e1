"""Predicates and flags over clinical codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def code_in_range(
    code: str | Column, low: str | Column, high: str | Column, include_subcodes: bool = False
) -> Column:
    """Lexicographic ``low <= code <= high``.

    ``include_subcodes`` also takes the sub-codes of the upper end (``E131`` for ``E13``); an empty
    upper end has none.
    """
    column = _column(code)
    low_end = F.lit(low) if isinstance(low, str) else low
    high_end = F.lit(high) if isinstance(high, str) else high
    upper = column <= high_end
    if include_subcodes:
        upper = upper | ((high_end != "") & column.startswith(high_end))
    return (column >= low_end) & upper


def code_in(code: str | Column, codes: Iterable[str]) -> Column:
    return _column(code).isin(list(codes))


def condition_flag(category: str, column: str | Column = "condition_category") -> Column:
    """Aggregate 0/1 flag: does any row of the group have this category?"""
    return F.max(F.when(_column(column) == category, 1).otherwise(0))
