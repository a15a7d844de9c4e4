"""Calendar-month period helpers (``YYYY-MM`` strings) as Column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted period shape is four digits, a dash and a month 01-12.
# ``\z`` (not ``$``) so a trailing newline does not pass (Java ``$`` matches before it).
PERIOD_PATTERN = r"^\d{4}-(0[1-9]|1[0-2])\z"
# Fixed value: periods before this first-of-month are too old.
OLDEST_PERIOD_START = "2018-01-01"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_of(ts: str | Column) -> Column:
    """Calendar month of a date/timestamp as ``YYYY-MM``."""
    return F.date_format(col_(ts), "yyyy-MM")


def is_period(p: str | Column) -> Column:
    """True when the string has the ``YYYY-MM`` shape (null for null input)."""
    return col_(p).rlike(PERIOD_PATTERN)


def period_start(p: str | Column) -> Column:
    """First day of the period; null when the text is not a valid period."""
    c = col_(p)
    return F.when(is_period(c), F.try_to_date(F.concat(c, F.lit("-01")), "yyyy-MM-dd"))


def previous_period(as_of: str | Column) -> Column:
    """Closed period before an as-of date: ``as_of - 1 month`` as ``YYYY-MM``."""
    return F.date_format(F.add_months(F.to_date(col_(as_of)), -1), "yyyy-MM")


def previous_period_py(as_of: _dt.date) -> str:
    """Driver-side twin of :func:`previous_period` for building plan parameters."""
    year, month = as_of.year, as_of.month - 1
    if month == 0:
        year, month = year - 1, 12
    return f"{year:04d}-{month:02d}"


def period_too_old(p: str | Column, oldest: str = OLDEST_PERIOD_START) -> Column:
    c = col_(p)
    return is_period(c) & (period_start(c) < F.to_date(F.lit(oldest)))


def period_in_future(p: str | Column, as_of: str | _dt.date) -> Column:
    """Period starts after ``as_of + 1 month``; ``as_of`` is an explicit parameter."""
    c = col_(p)
    return is_period(c) & (period_start(c) > F.add_months(F.to_date(F.lit(str(as_of))), 1))


def period_progress(p: str | Column, first: str, last: str) -> Column:
    """Linear position of a period inside ``[first, last]`` in 0..1."""
    span = F.months_between(period_start(F.lit(last)), period_start(F.lit(first)))
    pos = F.months_between(period_start(col_(p)), period_start(F.lit(first)))
    ratio = F.when(span <= 0, F.lit(0.0)).otherwise(pos / span)
    return F.least(F.greatest(ratio, F.lit(0.0)), F.lit(1.0))


def submission_timestamp(p: str | Column) -> Column:
    """Nominal submission time of a period: the 5th of the next month, 14:23:11 UTC."""
    nxt = F.add_months(period_start(col_(p)), 1)
    return F.make_timestamp(
        F.year(nxt), F.month(nxt), F.lit(5), F.lit(14), F.lit(23), F.lit(11).cast("decimal(16,6)"), F.lit("UTC")
    )
