"""Scalar functions on ordinary, awkward and hostile values."""

from decimal import Decimal
import hashlib
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions import identity, numbers, periods, terms, text
from siftworks.functions.numbers import canonical_number
from siftworks.presets.sales_feed import band_text


def test_money_is_exact_and_strict(evaluate):
    # Whole cents in every notation: the decimals decide, not a float.
    cents = [1, 7, 99, 100, 101, 4_070, 999_999, 31_250_000, 700_000_000_019, 2**63 - 1]
    plain = [f"{c // 100}.{c % 100:02d}" for c in cents]
    padded = [f"+00{p}0000000000000000000000" for p in plain]
    assert evaluate(numbers.money_cents, plain + padded) == cents * 2
    notations = {"4e2": 40_000, "7.25E1": 7_250, ".25": 25, "8.": 800, "12e-1": 120}
    assert evaluate(numbers.money_cents, list(notations)) == list(notations.values())
    broken = [f"{p}5" for p in plain[:8]] + ["3.141", "5e-3", "1e-2000", "0.000", "-0", "-8.50"]
    odd = ["92233720368547758.08", "12 50", "12,50", "12.5.0", "$12", "12.50 ", "1_000", "١", ".", "E2", "", None]
    assert evaluate(numbers.money_cents, broken + odd) == [None] * len(broken + odd)


def test_supplied_terms(evaluate):
    parse = lambda c: terms.supplied_months(c, 1188)
    years = [0, 1, 9, 42, 98, 99]
    for form in ("{}", "{} years", "{} year", "  {} YEARS\t"):
        assert evaluate(parse, [form.format(y) for y in years]) == [12 * y for y in years]
    # Months are 0 to 11, with or without a leading zero, up to the longest term.
    assert evaluate(parse, [f"42 years {m:02d} months" for m in range(14)]) == [504 + m for m in range(12)] + [None] * 2
    assert evaluate(parse, ["98 years 11 months", "99 years 0 month", "99 years 2 months", "101", "100 years"]) == [
        1187, 1188, None, None, None]
    odd = ["42.5", "42 yrs", "42years", "years 42", "4200", "42 years 3", "42 years, 3 months", "-42", "", None]
    assert evaluate(parse, odd) == [None] * len(odd)


def test_bands_of_the_feed_are_padded_not_formatted(spark):
    keys = spark.range(-25, 25).unionByName(spark.createDataFrame([(None,)], "id bigint"))
    low = 3 * (F.col("id") % 12) + 1
    bands = keys.select("id", band_text(F.col("id")).alias("b"))
    assert "format_string" not in bands._jdf.queryExecution().optimizedPlan().toString()
    formatted = keys.select("id", F.format_string("%02d TO %02d", low, low + 2).alias("b"))
    assert {(r.id, r.b) for r in bands.collect()} == {(r.id, r.b) for r in formatted.collect()}


def test_supplied_terms_are_read_without_failing_casts(spark):
    # A cast that fails makes and catches an exception: absent months were one in most rows.
    rows = spark.createDataFrame([("61",), ("",), ("61 years",), ("about 60 years",), (None,)], "t string")
    parsed = rows.select(terms.supplied_months(F.col("t"), 1188).alias("m"))
    assert "try_cast" not in parsed._jdf.queryExecution().optimizedPlan().toString()
    assert [r.m for r in parsed.collect()] == [732, None, 732, None, None]


def test_months(evaluate):
    good = [f"{y}-{m:02d}" for y in (1678, 1900, 2015, 2261) for m in range(1, 13)] + ["1677-10", "2262-04"]
    bad = [f"2015-{m}" for m in ("00", "13", "7", "007", "1 ", "Q1")]
    bad += ["15-07", "201507", "2015_07", "07-2015", "2015-07-", " 2015-07", "2015-07\n", "1677-09", "2262-05"]
    bad += ["２０１５-07", None]
    assert evaluate(periods.is_month, good + bad) == [True] * len(good) + [False] * len(bad)


def test_lenient_numbers(evaluate):
    got = evaluate(numbers.lenient_double, ["60", "60.0", "-1", "1e400", "60d", "nan", "inf", "", None])
    assert got == [60.0, 60.0, -1.0, None, None, None, None, None, None]


def test_canonical_numbers(evaluate):
    values = [60.0, 60.5, 0.0, 12345678.9, 1e10, 0.0001, 123456.75, 1e7, -2.0]
    got = evaluate(numbers.canonical_number, values, "double")
    assert got == ["60", "60.5", "0", "12345678.9", "10000000000", "0.0001", "123456.75", "10000000", "-2"]


def _expected(value):
    tidy = " ".join(unicodedata.normalize("NFKC", value).split()).upper()
    return tidy or None


AWKWARD = [
    "  ang   mo kio ", "Ａｎｇ　Ｍｏ", "straße", " x y ", "ﬁve", "a\u001fb", "\u001fa\u001c",
    "a\tb\r\n", "", "   ", "　", "école", "plain", "a\x85b", "a b",
]


@pytest.mark.parametrize("ascii_only", [False, True])
def test_normalisation_changes_presentation_only(evaluate, ascii_only):
    values = [v for v in AWKWARD if not ascii_only or v.isascii()]
    got = evaluate(lambda c: text.normalize_text(c, ascii_only), values)
    assert got == [_expected(v) for v in values]
    assert evaluate(text.normalize_text, [None]) == [None]


def test_strip_knows_every_white_space(evaluate):
    assert evaluate(text.strip, AWKWARD) == [v.strip() for v in AWKWARD]
    assert evaluate(text.blank_to_null, AWKWARD) == [v.strip() or None for v in AWKWARD]


def test_remaining_term_arithmetic(spark):
    rows = spark.createDataFrame([(1980, 2015, 2), (1980, 2015, 12)], "s bigint, y bigint, m bigint")
    months = terms.remaining_months(F.col("s"), F.col("y"), F.col("m"), 99)
    got = rows.select(
        months.alias("t"), terms.whole_years(months).alias("y"), terms.years_and_months(months).alias("d")
    ).collect()
    assert [tuple(r) for r in got] == [(767, 63, "63 years 11 months"), (757, 63, "63 years 01 months")]


def test_record_id_is_the_digest_of_a_json_list(spark):
    name = 'a "b", é.csv'
    row = spark.createDataFrame([(name, "ab", 7)], "f string, d string, r bigint").select(
        identity.record_id(F.col("f"), F.col("d"), F.col("r")).alias("id")
    ).first()
    listed = json.dumps([name, "ab", 7], ensure_ascii=False, separators=(",", ":"))
    assert row.id == hashlib.sha256(listed.encode()).hexdigest()


def test_canonical_key_keeps_nulls_and_order(spark):
    row = spark.createDataFrame([("x|y", None)], "b string, a string").select(
        identity.canonical_key({"b": F.col("b"), "a": F.col("a")}).alias("k")
    ).first()
    assert row.k == '[["a",null],["b","x|y"]]'


def test_configuration_is_checked():
    for bad in (
        {"start_month": "2012-1"}, {"reference_month": "2011-12"}, {"lease_years": 0},
        {"anomaly_min_peers": 3}, {"anomaly_iqr_multiplier": 0},
    ):
        with pytest.raises(ValueError):
            JobConfig(**bad)


def test_canonical_number_is_always_plain(evaluate):
    values = [1e19, -1.5e22, 1e-13, 1.25e-7, 12345678.901, 60.0, 0.0, -0.001, 1e300]
    found = evaluate(canonical_number, values, "double")
    assert found == [f"{Decimal(repr(v)).normalize():f}" if v else "0" for v in values]


def test_plain_numbers_are_spelled_without_patterns(spark):
    """Patterns run only on numbers in scientific form; before, several ran on every number."""
    spelled = numbers.canonical_number(F.col("x"))
    rows = spark.createDataFrame([(x,) for x in (60.0, -60.0, 0.5, -0.0, 9999999.0, 1e7, 1.25e-4, None)], "x double")
    assert [r[0] for r in rows.select(spelled).collect()] == [
        "60", "-60", "0.5", "0", "9999999", "10000000", "0.000125", None]
    guards = [spelled._jc.toString().find(mark) for mark in ("endswith", "contains", "REGEXP_EXTRACT", "regexp_extract")]
    first = min(at for at in guards[2:] if at >= 0)
    assert 0 <= guards[0] < first and 0 <= guards[1] < first
