"""Calendar fields used as period keys.

Analysis weeks run Sunday..Saturday and are labelled by their Saturday.
ISO week numbers (1..53, Monday-based) key the seasonal baselines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(c) -> Column:
    """Timestamp (or ISO string) to DATE."""
    return F.to_date(c)


def week_ending_saturday(d: Column) -> Column:
    """The Saturday on or after ``d``; a Sunday belongs to the next Saturday.

    ``weekday`` is 0 for Monday .. 6 for Sunday, so ``(12 - weekday) % 7`` is
    the number of days to the coming Saturday.
    """
    return F.date_add(d, (F.lit(12) - F.weekday(d)) % 7)


def last_saturday_on_or_before(d: Column) -> Column:
    """The Saturday on or before ``d`` (the default analysis week)."""
    return F.date_sub(d, (F.weekday(d) + 2) % 7)


def iso_week(d: Column) -> Column:
    """ISO-8601 week number, 1..53 (no year), as INT."""
    return F.weekofyear(d)


def iso_year(d: Column) -> Column:
    """ISO-8601 week-numbering year, as INT."""
    return F.extract(F.lit("YEAROFWEEK"), d)
