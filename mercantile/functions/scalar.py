"""Scalar helpers (built-in Catalyst expressions only, no Python UDFs)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations in calendar order (pivot labels and
# the 'Mon' month token of the sales report).
MONTH_LABELS: tuple[str, ...] = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def years_before(as_of: dt.date | str | None, years: int) -> Column:
    """``as_of - INTERVAL 'n years'`` as a foldable date (Feb 29 -> Feb 28).

    ``as_of`` defaults to the query's current date (``CURRENT_DATE``); pass it
    for repeatable results.  Either way it folds to a literal, so the
    comparison reaches the Parquet scan as a pushed filter."""
    base = F.current_date() if as_of is None else F.lit(as_date(as_of))
    return F.add_months(base, -12 * years)


def month_range(year: int, month: int) -> tuple[dt.date, dt.date]:
    """Half-open [first day, first day of next month): pushes down as two bounds,
    unlike ``year(d) = y AND month(d) = m`` which stays a row filter."""
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    return start, end


def in_month(c: Column | str, year: int, month: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    start, end = month_range(year, month)
    return (c >= F.lit(start)) & (c < F.lit(end))


def month_number(token: str) -> int:
    """'Jan' / 'jan' / 'JAN' -> 1, like ``TO_DATE(token, 'Mon')``."""
    t = token.strip().title()[:3]
    if t not in MONTH_LABELS:
        raise ValueError(f"not a month token: {token!r}")
    return MONTH_LABELS.index(t) + 1


def month_label(c: Column | str) -> Column:
    """Date -> 'Jan' .. 'Dec'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "MMM")


def money(c: Column | str, precision: int = 12) -> Column:
    """Cast to DECIMAL(p,2): rounds half away from zero, like storing into NUMERIC."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal({precision},2)")


def scale(c: Column | str, factor: str | Decimal, precision: int = 10) -> Column:
    """``c * factor`` stored back into DECIMAL(p,2); the factor is an exact decimal."""
    c = F.col(c) if isinstance(c, str) else c
    return (c * F.lit(Decimal(str(factor)))).cast(f"decimal({precision},2)")


def as_double(c: Column | str) -> Column:
    """Exact decimal result handed out as DOUBLE (the nearest double)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def iso_date(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def two_decimals(c: Column | str) -> Column:
    """Python's ``'{:.2f}'`` for a decimal: round to 2 places, then text."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,2)").cast("string")


def placeholder(c: Column | str, text: str) -> Column:
    """NULL -> display text.  Only NULL is missing: key 0 and amount 0 are values."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(text))


def indent(level: Column | str, unit: str = "  ") -> Column:
    level = F.col(level) if isinstance(level, str) else level
    return F.repeat(F.lit(unit), level)
