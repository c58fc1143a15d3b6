"""Report period: day bounds, closed ranges and calendar-day tests.

All bounds are constant expressions, so Catalyst folds them to literals and
the range reaches the Parquet scan as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The report's day ends at 23:59:59 (a closed range), so the last fraction of
# a second of the day is outside it.
_DAY_END = "INTERVAL '23:59:59' HOUR TO SECOND"


def ts_literal(value: str | _dt.date | _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal (the test Parquet loads as timestamp_ntz)."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def day_start(value) -> Column:
    """Midnight of the given moment (``dateonly``).

    Through a date, not ``date_trunc``: no session time zone is involved,
    so a zone whose clocks skip midnight cannot shift the bound.
    """
    c = value if isinstance(value, Column) else ts_literal(value)
    return F.to_date(c).cast("timestamp_ntz")


def period_bounds(first_day, last_day=None) -> tuple[Column, Column]:
    """``[midnight(first), midnight(last) + 23:59:59]``; ``last`` defaults to ``first``."""
    begin = day_start(first_day)
    end = day_start(first_day if last_day is None else last_day) + F.expr(_DAY_END)
    return begin, end


def in_period(col: str | Column, bounds: tuple[Column, Column]) -> Column:
    """Closed range test ``col BETWEEN begin AND end``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.between(bounds[0], bounds[1])


def same_calendar_day(col: str | Column, day) -> Column:
    """Year, month and day parts equal those of ``day``.

    Written as the half-open range ``[midnight, next midnight)`` on the bare
    column, so the predicate reaches the Parquet scan (three part tests or a
    cast of the column would not).
    """
    c = F.col(col) if isinstance(col, str) else col
    start = day_start(day)
    return (c >= start) & (c < start + F.expr("INTERVAL 1 DAY"))


def day_parts_equal(col: str | Column, day) -> Column:
    """The literal three-part test ``YEAR = YEAR AND MONTH = MONTH AND DAY = DAY``."""
    c = F.col(col) if isinstance(col, str) else col
    d = day if isinstance(day, Column) else ts_literal(day)
    return (
        (F.year(c) == F.year(d))
        & (F.month(c) == F.month(d))
        & (F.dayofmonth(c) == F.dayofmonth(d))
    )


def date_in_period(col: str | Column, bounds: tuple[Column, Column]) -> Column:
    """``CAST(col AS DATE) BETWEEN begin AND end``.

    The day of ``col`` lies in the period exactly when ``col`` lies in
    ``[midnight(begin), midnight(end) + 1 day)``; written that way on the bare
    column it is pushed to the scan.
    """
    c = F.col(col) if isinstance(col, str) else col
    lo = day_start(bounds[0])
    hi = day_start(bounds[1]) + F.expr("INTERVAL 1 DAY")
    return (c >= lo) & (c < hi)


def period_filter(df, col: str, bounds: tuple[Column, Column], by_day: bool = False, day_col: str | None = None):
    """``df`` restricted to ``col BETWEEN begin AND end`` (or, ``by_day``, to
    ``CAST(col AS DATE) BETWEEN begin AND end``).

    ``day_col`` names a partition column that whoever writes the table
    guarantees to hold ``CAST(col AS DATE)``; the matching day range is added,
    so whole partitions are pruned. It is never inferred from column names.
    """
    out = df.where(date_in_period(col, bounds) if by_day else in_period(col, bounds))
    if day_col is not None:
        out = out.where(F.col(day_col).between(F.to_date(bounds[0]), F.to_date(bounds[1])))
    return out
