"""Months written as YYYY-MM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The written form, and the months a nanosecond timestamp can hold.
MONTH_TEXT = "[0-9]{4}-(?:0[1-9]|1[0-2])"
MONTH_FORM = rf"^{MONTH_TEXT}\z"
FIRST_MONTH, LAST_MONTH = "1677-10", "2262-04"


def is_month(text: Column) -> Column:
    """True for a well-formed, representable month; false for null."""
    good = text.rlike(MONTH_FORM) & text.between(FIRST_MONTH, LAST_MONTH)
    return F.coalesce(good, F.lit(False))


def year_of(month: Column) -> Column:
    return F.substring(month, 1, 4).try_cast("bigint")


def month_of(month: Column) -> Column:
    return F.substring(month, 6, 2).try_cast("bigint")
