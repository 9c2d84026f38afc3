"""Canonical keys, digests and the nine-character business code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the written form of a business code.
BUSINESS_CODE_FORM = r"^S[0-9]{7}[A-Z]\z"
# Fixed value: bytes of a SHA-256 digest.
_PACKED = 32


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def packed(text: Column) -> Column:
    """Binary form of a text, half as long for a digest in hex; :func:`unpacked` gives it back.

    Different texts have different forms: those of digests have 32 bytes, all others more.
    """
    other = F.concat(F.lit(bytes(_PACKED + 1)), text.cast("binary"))
    return F.when(text.rlike(r"^[0-9a-f]{64}\z"), F.unhex(text)).otherwise(other)


def unpacked(form: Column) -> Column:
    other = F.substring(form, F.lit(_PACKED + 2), F.length(form)).cast("string")
    return F.when(F.length(form) == _PACKED, F.lower(F.hex(form))).otherwise(other)


def canonical_key(values: Mapping[str, Column]) -> Column:
    """JSON pairs of name and text value, names sorted, nulls spelled out."""
    pairs = [
        F.array(F.lit(name), values[name].cast("string")) for name in sorted(values)
    ]
    return F.to_json(F.array(*pairs))


def quoted(text: Column) -> Column:
    """The JSON string literal of a text."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def record_id(file: Column, digest: Column, row: Column) -> Column:
    """Digest of the JSON list of file name, file digest and data row number."""
    return sha256(F.concat(
        F.lit("["), quoted(file), F.lit(","), quoted(digest), F.lit(","),
        row.cast("string"), F.lit("]"),
    ))


def business_code(code_text: Column, whole_units: Column, month: Column, name: Column) -> Column:
    """``S``, three digits of the code, two leading digits of the mean, month, initial."""
    digits = F.lpad(F.regexp_replace(code_text, "[^0-9]", ""), 3, "0")
    leading = F.lpad(whole_units.cast("string"), 2, "0")
    return F.concat(F.lit("S"), digits, leading, F.substring(month, -2, 2), F.substring(name, 1, 1))
