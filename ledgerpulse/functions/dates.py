"""Calendar expressions over zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Calendar months from ``earlier`` to ``later``, ignoring the day."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def whole_days(later: Column, earlier: Column) -> Column:
    """Full 24-hour days between two timestamps (89 days 23:50 gives 89)."""
    return F.extract(F.lit("DAY"), later - earlier)
