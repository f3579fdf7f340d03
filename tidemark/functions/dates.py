"""Month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(column: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(column, "month")


def whole_months_between(later: Column, earlier: Column) -> Column:
    """Difference of calendar months, days ignored."""
    years = F.year(later) - F.year(earlier)
    return years * 12 + F.month(later) - F.month(earlier)
