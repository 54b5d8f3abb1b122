"""Calendar helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_month(c) -> Column:
    """``yyyy-MM`` text of a date."""
    return F.date_format(_column(c), "yyyy-MM")


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0, so that the calendar month before is always ``index - 1``."""
    return year * 12 + month
