"""Roles, rules and derived columns of property-sale records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions import identity, numbers, periods, terms, text
from siftworks.functions.naming import col
from siftworks.operators.fences import PeerLevel
from siftworks.operators.reference import Reference, band_bounds
from siftworks.operators.rules import Rule, failed_reasons

# Source columns every input must have, in source order.
REQUIRED = (
    "month", "town", "flat_type", "block", "street_name", "storey_range",
    "floor_area_sqm", "flat_model", "lease_commence_date", "resale_price",
)
# Columns whose values must occur in the reference month.
CATEGORIES = ("town", "flat_type", "flat_model", "storey_range")
BANDS = ("storey_range",)
NORMALIZED = (*CATEGORIES, "block", "street_name")
SUPPLIED_TERM = "remaining_lease"
AMOUNT = "resale_price"
# Derived names a source may not use.
RESERVED = (
    "transaction_year", "transaction_month", "remaining_lease_years", "remaining_lease_months",
    "remaining_lease_total_months", "remaining_lease_years_months", "price_per_sqm",
    "Resale Identifier", "group_average_resale_price", "resale_identifier_hash",
    "resale_record_hash",
)
# Lineage carried by every row.
LINEAGE = ("_source_row", "_source_file", "_source_sha256", "_source_record_id")
# Peer groups of the price fences, most specific first.
PEER_LEVELS = (
    PeerLevel("town_flat_type_year", ("town", "flat_type", "transaction_year")),
    PeerLevel("town_flat_type_all_years", ("town", "flat_type")),
    PeerLevel("flat_type_year", ("flat_type", "transaction_year")),
)
MEAN_KEYS = ("month", "town", "flat_type")
# Reasons of the two later stages.
DUPLICATE_REASON = "duplicate_non_maximum_or_tied_price"
ANOMALY_REASON = "potential_price_anomaly"

# Derived columns, price evidence and decision of the published rows.
DERIVED = (
    "transaction_year", "transaction_month", "remaining_lease_total_months",
    "remaining_lease_years", "remaining_lease_months", "remaining_lease_years_months",
    "price_per_sqm", "_date_basis", "_provided_lease_months",
    "_provided_lease_difference_months", "_lease_comparison_note",
)
EVIDENCE = (
    "_anomaly_peer_level", "_anomaly_peer_count", "_anomaly_lower_ppsqm", "_anomaly_upper_ppsqm",
)
DECISION = ("_quarantine_stage", "_quarantine_reasons", "_reference_source_record_id")


def source_columns(frame: DataFrame) -> list[str]:
    return sorted(c for c in frame.columns if not c.startswith("_"))


def _known(column: str) -> str:
    return f"_known_{column}"


def composed(column: str) -> str:
    """The column that holds a source column's composed text, where it was composed before."""
    return f"_composed_{column}"


def clean_text(
    master: DataFrame, columns: Sequence[str], ascii_columns: frozenset[str] = frozenset()
) -> DataFrame:
    """Keep the originals in ``_raw`` and replace every source column by tidy text."""
    present = set(master.columns)

    def tidied(c: str) -> Column:
        if c not in NORMALIZED:
            return text.blank_to_null(col(c))
        if composed(c) in present:
            return text.normalize_text(col(composed(c)), True)
        return text.normalize_text(col(c), c in ascii_columns)

    tidy = [tidied(c).alias(c) for c in columns]
    recorded = F.col("month").alias("_recorded_month")
    return master.select(*LINEAGE, F.struct(*[col(c) for c in columns]).alias("_raw"), recorded, *tidy)


def _parsed(rows: DataFrame, config: JobConfig) -> DataFrame:
    """Typed readings of the tidy text; a reading that fails is null."""
    low, high = band_bounds(F.col("storey_range"))
    dated = periods.is_month(F.col("month"))
    rows = rows.withColumns({
        "_dated": dated,
        "_low": low,
        "_high": high,
        "_area": numbers.lenient_double(F.col("floor_area_sqm")),
        "_start": numbers.lenient_double(F.col("lease_commence_date")),
        "_price_cents": numbers.money_cents(F.col(AMOUNT)),
        "_provided": (
            terms.supplied_months(F.col(SUPPLIED_TERM), config.term_months)
            if SUPPLIED_TERM in rows.columns
            else F.lit(None).cast("bigint")
        ),
    })
    rows = rows.withColumns({
        "_year": F.when(F.col("_dated"), periods.year_of(F.col("month"))),
        "_month": F.when(F.col("_dated"), periods.month_of(F.col("month"))),
    })
    return rows.withColumn(
        "_months",
        terms.remaining_months(F.col("_start"), F.col("_year"), F.col("_month"), config.lease_years),
    )


def rules(columns: Sequence[str], config: JobConfig) -> list[Rule]:
    """The rules in reporting order, over the columns of :func:`_parsed`."""
    months = F.col("_months")
    low, high = F.col("_low"), F.col("_high")
    listed = [Rule(f"missing:{c}", F.col(c).isNull()) for c in sorted(REQUIRED)]
    listed += [
        Rule("invalid_date", ~F.col("_dated")),
        Rule(
            "outside_requested_period",
            F.col("_dated") & ~F.col("month").between(config.start_month, config.end_month),
        ),
    ]
    listed += [Rule(f"not_in_reference:{c}", ~F.col(_known(c))) for c in CATEGORIES]
    listed += [
        Rule("invalid_storey_range", low.isNull() | high.isNull() | (low < 1) | (low > high)),
        Rule("block_has_no_digits", ~F.col("block").rlike("[0-9]")),
        Rule("invalid_floor_area", F.col("_area") <= 0),
        Rule("invalid_lease_commence_year", ~F.col("lease_commence_date").rlike(r"^[0-9]{4}\z")),
        Rule("lease_outside_0_to_99_years", (months <= 0) | (months > config.term_months)),
        Rule("invalid_resale_price", F.col("_price_cents").isNull()),
    ]
    if SUPPLIED_TERM in columns:
        listed.append(Rule(
            "invalid_provided_remaining_lease",
            F.col(SUPPLIED_TERM).isNotNull() & F.col("_provided").isNull(),
        ))
    return listed


def assess(
    master: DataFrame,
    reference: Reference,
    config: JobConfig,
    *,
    ascii_columns: frozenset[str] = frozenset(),
) -> DataFrame:
    """One row per master row: originals, typed values, derived values and failed rules.

    A narrow plan: no shuffle, no Python unless a text column holds non-ASCII.
    Rows that fail a rule carry the stage ``validation`` and no derived values.
    """
    columns = source_columns(master)
    rows = _parsed(clean_text(master, columns, ascii_columns), config)
    rows = reference.mark_known(rows, CATEGORIES, _known)
    rows = rows.withColumn("_quarantine_reasons", failed_reasons(rules(columns, config)))
    valid = F.size("_quarantine_reasons") == 0
    rows = rows.withColumn("_quarantine_stage", F.when(~valid, "validation"))

    def kept(value: Column) -> Column:
        return F.when(valid, value)

    typed = {
        AMOUNT: kept(F.col("_price_cents") / F.lit(100.0)),
        "floor_area_sqm": kept(F.col("_area")),
        "lease_commence_date": kept(F.col("_start").cast("bigint")),
    }
    months = kept(F.col("_months").cast("bigint"))
    typed_rows = rows.select(
        *LINEAGE,
        "_raw",
        "_recorded_month",
        *[typed[c].alias(c) if c in typed else kept(col(c)).alias(c) for c in columns],
        kept(F.col("_price_cents")).alias("_price_cents"),
        kept(F.col("_year")).alias("transaction_year"),
        kept(F.col("_month")).alias("transaction_month"),
        months.alias("remaining_lease_total_months"),
        kept(F.col("_provided")).alias("_provided_lease_months"),
        "_quarantine_stage",
        "_quarantine_reasons",
    )
    return _derived(typed_rows, config)


def _derived(rows: DataFrame, config: JobConfig) -> DataFrame:
    valid = F.col("_quarantine_stage").isNull()
    months = F.col("remaining_lease_total_months")
    difference = F.col("_provided_lease_months") - months
    rows = rows.withColumns({
        "remaining_lease_years": terms.whole_years(months),
        "remaining_lease_months": months % 12,
        "remaining_lease_years_months": terms.years_and_months(months),
        "price_per_sqm": F.col(AMOUNT) / F.col("floor_area_sqm"),
        "_date_basis": F.when(
            valid, terms.date_basis(F.col("month"), config.registration_from)
        ),
        "_provided_lease_difference_months": difference,
        "_lease_comparison_note": F.when(valid, terms.comparison_note(difference)),
    })
    return rows.withColumn("_key_hash", F.when(valid, identity.sha256(composite_key(rows))))


def key_columns(columns: Sequence[str]) -> list[str]:
    return sorted(c for c in columns if c != AMOUNT)


def composite_key(rows: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Canonical JSON of every source column except the price."""
    doubles = {f.name for f in rows.schema.fields if f.dataType.simpleString() == "double"}
    return identity.canonical_key({
        c: numbers.canonical_number(col(c)) if c in doubles else col(c)
        for c in key_columns(columns or source_columns_of(rows))
    })


def source_columns_of(rows: DataFrame) -> list[str]:
    """Source columns of an assessed frame: the fields kept in ``_raw``."""
    return [f.name for f in rows.schema["_raw"].dataType.fields]


def best_first() -> list[Column]:
    """Highest price first; ties by file name, then data row."""
    return [-F.col("_price_cents"), F.col("_source_file"), F.col("_source_row")]


def identifier(whole: str) -> Column:
    return identity.business_code(F.col("block"), F.col(whole), F.col("month"), F.col("town"))
