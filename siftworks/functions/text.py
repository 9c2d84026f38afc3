"""Text presentation: Unicode form, whitespace and case."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode calls white space plus the four ASCII
# information separators, in code-point order.
WHITESPACE = "".join(
    map(chr, [
        0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
        0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
        0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ])
)
_SPACES = f"[{WHITESPACE}]+"
# Cheap tests that let tidy text, nearly all of it, skip the slow functions.
_ODD_EDGE = r"^[^!-~]|[^!-~]\z"
_ODD = r"[^ -~]|  |^ | \z"
_NON_ASCII = r"[^\x00-\x7F]"


def _compose(values: pd.Series) -> pd.Series:
    return values.map(
        lambda text: unicodedata.normalize("NFKC", text), na_action="ignore"
    ).astype(object)


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition.

    Spark has no built-in for it. ASCII text is already in that form, so it
    reaches the Arrow batch as null and never becomes a Python string.
    """
    compose = F.pandas_udf(_compose, "string")
    return F.coalesce(compose(F.when(has_non_ascii(text), text)), text)


def has_non_ascii(text: Column) -> Column:
    return text.rlike(_NON_ASCII)


def strip(text: Column) -> Column:
    return F.when(text.rlike(_ODD_EDGE), F.trim(text, F.lit(WHITESPACE))).otherwise(text)


def blank_to_null(text: Column) -> Column:
    """Strip, then treat empty text as missing."""
    return F.nullif(strip(text), F.lit(""))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def normalize_text(text: Column, ascii_only: bool = False) -> Column:
    """Composed, stripped, single-spaced, upper-case text; blank becomes null.

    ``ascii_only`` may be set when the column was measured to hold ASCII only,
    which keeps the whole expression in the JVM.
    """
    composed = text if ascii_only else nfkc(text)
    spaced = F.trim(F.regexp_replace(composed, _SPACES, " "))
    tidy = F.when(composed.rlike(_ODD), spaced).otherwise(composed)
    return F.nullif(F.upper(tidy), F.lit(""))
