"""Calendar-boundary differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date | Column) -> Column:
    """A date column from an ISO string, a Python date or a column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def years_crossed(later: Column, earlier: Column) -> Column:
    """New Year boundaries between two dates (31 Dec -> 1 Jan counts as one)."""
    return F.year(later) - F.year(earlier)


def months_crossed(later: Column, earlier: Column) -> Column:
    """Month boundaries between two dates (31 Jan -> 1 Feb counts as one)."""
    return years_crossed(later, earlier) * 12 + (F.month(later) - F.month(earlier))


def last_day_of_year(year: int) -> Column:
    return F.make_date(F.lit(year), F.lit(12), F.lit(31))
