"""Date expressions. Today is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Fixed value: the date that stands for "never ends".
NEVER_ENDS = dt.date(2999, 12, 31)


def span_covers(begin: Column, end: Column, day: dt.date) -> Column:
    """Begun before ``day`` and not ended by it; both ends strict, NULL end is open."""
    on = F.lit(day)
    return (begin < on) & (end.isNull() | (end > on))


def within_months_before(when: Column, day: dt.date, months: int) -> Column:
    """Between ``months`` before ``day`` and ``day``, both ends included; month end goes to month end."""
    on = F.lit(day)
    return when.between(add_months_eom(on, -months), on)


def whole_years(birth: Column, day: dt.date | Column) -> Column:
    """Completed years at ``day``."""
    on = day if isinstance(day, Column) else F.lit(day)
    return F.floor(F.months_between(on, birth) / 12).cast("int")


def add_months_eom(day: Column, months: int) -> Column:
    """Add months; the last day of a month goes to the last day of the target month.

    ``F.add_months`` keeps the day number instead (28 February + 1 is 28 March).
    """
    moved = F.add_months(day, months)
    return F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def parse_date(text: Column, pattern: str, strict: bool = False) -> Column:
    """Text to date; bad text gives NULL, or an error if ``strict``."""
    return F.to_date(text, pattern) if strict else F.try_to_date(text, pattern)


def day_month_year(day: Column) -> Column:
    """For example ``16-OCT-2026``."""
    return F.upper(F.date_format(day, "dd-MMM-yyyy"))


def due_after(day: Column, days: int) -> Column:
    return F.date_add(day, days)
