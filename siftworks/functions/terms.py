"""Fixed-length terms measured in complete months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftworks.functions.text import strip

# Fixed value: a supplied term, in years or in years and up to 11 months.
TERM_FORM = r"^([0-9]{1,3})(?: years?(?: (0?[0-9]|1[01]) months?)?)?\z"

# How a supplied term compares with the computed one.
NOTE_ABSENT = "source value absent"
NOTE_REVIEW = "review: difference exceeds 12 months"
NOTE_WITHIN = "within year/month precision allowance"


def remaining_months(start_year: Column, year: Column, month: Column, term_years: int) -> Column:
    """Months left at the start of a month, for a term that began on 1 January."""
    return (start_year + F.lit(term_years) - year) * 12 - (month - 1)


def whole_years(months: Column) -> Column:
    return F.floor(months / 12).cast("bigint")


def years_and_months(months: Column) -> Column:
    """Display text such as ``63 years 01 months``."""
    rest = F.lpad((months % 12).cast("string"), 2, "0")
    return F.concat(whole_years(months).cast("string"), F.lit(" years "), rest, F.lit(" months"))


def supplied_months(text: Column, longest: int) -> Column:
    """Months in a supplied term: whole years, or years with optional months."""
    words = F.lower(strip(text))

    def number(group: int) -> Column:
        # The leading zero stands for an absent number: a cast that fails costs an exception.
        return F.concat(F.lit("0"), F.regexp_extract(words, TERM_FORM, group)).cast("bigint")

    # Too long a term becomes null without being read a second time.
    too_long = F.lit(longest + 1).cast("bigint")
    months = F.nullif(F.least(number(1) * 12 + number(2), too_long), too_long)
    return F.when(words.rlike(TERM_FORM), months)


def comparison_note(difference: Column) -> Column:
    return (
        F.when(difference.isNull(), NOTE_ABSENT)
        .when(F.abs(difference) > 12, NOTE_REVIEW)
        .otherwise(NOTE_WITHIN)
    )


def date_basis(month: Column, registration_from: str) -> Column:
    return F.when(month < registration_from, "approval").otherwise("registration")
