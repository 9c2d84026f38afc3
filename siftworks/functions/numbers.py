"""Numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain or scientific notation in ASCII digits.
NUMBER_FORM = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]{1,4})?\z"
# A positive plain number with no digit but zero after the second decimal.
_PLAIN_CENTS = r"^\+?(?=[0-9.]*[1-9])[0-9]*(?:\.[0-9]{0,2}0*)?\z"
_SCIENTIFIC = r"^[+-]?(?:[0-9]+\.?([0-9]*)|\.([0-9]+))[eE]([+-]?[0-9]{1,4})\z"
EXACT_SCALE = 18


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def lenient_double(text: Column) -> Column:
    """The finite number a text spells, else null."""
    value = F.when(text.rlike(NUMBER_FORM), text).try_cast("double")
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def money_cents(text: Column) -> Column:
    """Positive whole cents as bigint; null for anything else.

    The text is read as an exact decimal. In scientific notation a text that
    spells more than 18 decimals is refused, because Spark would round it.
    """
    hundred = F.lit(100).cast("decimal(3,0)")
    amount = F.when(text.rlike(_PLAIN_CENTS), text).try_cast(f"decimal(38,{EXACT_SCALE})")
    plain = (amount * hundred).try_cast("bigint")
    decimals = F.length(F.regexp_extract(text, _SCIENTIFIC, 1)) + F.length(
        F.regexp_extract(text, _SCIENTIFIC, 2)
    )
    exponent = F.regexp_extract(text, _SCIENTIFIC, 3).try_cast("int")
    exact = F.when(decimals - exponent <= EXACT_SCALE, text)
    scaled = F.array(exact.try_cast(f"decimal(38,{EXACT_SCALE})") * hundred)
    whole = F.filter(scaled, lambda cents: (cents > 0) & (cents == F.floor(cents)))
    return F.when(text.rlike(_SCIENTIFIC), F.get(whole, 0).try_cast("bigint")).otherwise(plain)


def canonical_number(value: Column) -> Column:
    """Plain decimal text of a double, without trailing zeros: 60.0 becomes 60."""
    text = value.cast("string")
    part = lambda i: F.regexp_extract(text, r"^-?([0-9]+)\.([0-9]+)E(-?[0-9]+)\z", i)
    # All digits of d.dddEx; the point belongs after x more of them.
    digits = F.rtrim(F.concat(part(1), part(2)), F.lit("0"))
    power = part(3).try_cast("int")
    whole = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0"))
    rest = F.substring(digits, power + 2, F.length(digits))
    large = F.when(rest == "", whole).otherwise(F.concat(whole, F.lit("."), rest))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    sign = F.when(value < 0, "-").otherwise("")
    return (
        F.when(value == 0, F.lit("0"))
        .when(text.endswith(".0"), F.substring(text, F.lit(1), F.length(text) - 2))
        .when(~text.contains("E"), text)
        .when(power >= 0, F.concat(sign, large))
        .when(power < 0, F.concat(sign, small))
        .otherwise(F.regexp_replace(text, r"\.0\z", ""))
    )
