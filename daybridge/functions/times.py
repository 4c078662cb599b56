"""Calendar arguments, period predicates and time formats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats of the aggregate and raw exports.
DAY_FORMAT = "yyyy.MM.dd"
MONTH_FORMAT = "yyyy.MM.01"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def as_date(value: dt.date | str) -> dt.date:
    """Accept a date, ``YYYY-MM-DD`` or ``YYYYMMDD``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def month_start(value: dt.date | str) -> dt.date:
    return as_date(value).replace(day=1)


def next_month(value: dt.date) -> dt.date:
    return (value.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def between_days(column: str | Column, start: dt.date | str, end: dt.date | str) -> Column:
    """Whole days ``start`` to ``end``, both included.

    A half-open range on the bare column: unlike a truncated column it reaches the Parquet
    scan as a pushed filter and prunes date partitions.
    """
    c = _col(column)
    return (c >= F.lit(as_date(start))) & (c < F.lit(as_date(end) + dt.timedelta(days=1)))


def between_months(column: str | Column, start: dt.date | str, end: dt.date | str) -> Column:
    """Whole months holding ``start`` to ``end``, both included; same range form."""
    c = _col(column)
    return (c >= F.lit(month_start(start))) & (c < F.lit(next_month(month_start(end))))


def day_text(column: str | Column) -> Column:
    return F.date_format(_col(column), DAY_FORMAT)


def month_text(column: str | Column) -> Column:
    return F.date_format(_col(column), MONTH_FORMAT)


def second_text(column: str | Column) -> Column:
    return F.date_format(_col(column), SECOND_FORMAT)


def day_sequence(first: Column, last: Column, step: str = "day") -> Column:
    """Array of dates from ``first`` to ``last`` by day or month; NULL when reversed."""
    if step not in ("day", "month"):
        raise ValueError(f"step must be 'day' or 'month', not {step!r}")
    if step == "month":
        first, last = F.trunc(first, "month"), F.trunc(last, "month")
    return F.when(first <= last, F.sequence(first, last, F.expr(f"interval 1 {step}")))
