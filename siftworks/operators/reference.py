"""Allowed category values, learned from one frozen period."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions.text import normalize_text, strip
from siftworks.operators.attach import attach
from siftworks.staging import Staged, Staging

# Fixed value: the written form of a band.
BAND_FORM = r"^([0-9]{2}) TO ([0-9]{2})\z"
# A domain of at most this many values becomes a literal set in the plan.
LITERAL_VALUES = 5_000


@dataclass(frozen=True)
class Reference:
    """Staged ``column, value, n`` rows and what was measured while learning them."""

    table: Staged
    staging: Staging
    rows: int
    sizes: dict[str, int]
    literals: dict[str, list[str]] = field(repr=False)

    @property
    def frame(self) -> DataFrame:
        return self.table.frame.select("column", "value", "n")

    def mark_known(self, rows: DataFrame, columns: Sequence[str], flag) -> DataFrame:
        """Add a boolean ``flag(column)`` per column: is the value in its domain?"""
        rows = rows.withColumns({
            flag(c): F.coalesce(F.col(c).isin(self.literals[c]), F.lit(False))
            for c in columns
            if c in self.literals
        })
        for column in columns:
            if column in self.literals:
                continue
            # Weights are the values' counts in the rows themselves: a value that
            # fills the rows may be rare in the domain, or missing from it.
            domain = self.frame.where(F.col("column") == column).select(
                F.col("value").alias(column), F.lit(True).alias("_in_domain")
            )
            counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_sw_n"))
            lookup = self.staging.write(counted.join(domain, column, "left"), "values")
            rows = (
                attach(rows, lookup.frame, lookup, [column], spread=["_source_record_id"])
                .withColumn(flag(column), F.col("_in_domain").isNotNull())
                .drop("_sw_n", "_in_domain")
            )
        return rows

    def report(self, config: JobConfig, table: str) -> dict:
        """The published description; ``table`` is where every value of every domain lies.

        Its form is the same for domains of any size.
        """
        # The names of the report's entries.
        return {
            "reference_month": config.reference_month,
            "reference_rows": self.rows,
            "date_format": "YYYY-MM",
            "date_scope": [config.start_month, config.end_month],
            "domains": {c: {"size": n, "values_in": table} for c, n in self.sizes.items()},
        }


def category_values(
    rows: DataFrame, columns: Sequence[str], ascii_columns: frozenset[str] = frozenset()
) -> DataFrame:
    """``column, value, n``: how often each normalised category value occurs.

    Texts are counted as they are first, so that only distinct ones are normalised.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    counted = (
        rows.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    tidy = normalize_text(F.col("value"), ascii_columns.issuperset(columns))
    return counted.select("column", tidy.alias("value"), "n").groupBy("column", "value").agg(F.sum("n").alias("n"))


def build_reference(
    master: DataFrame,
    config: JobConfig,
    columns: Sequence[str],
    staging: Staging,
    *,
    period: str = "month",
    bands: Sequence[str] = (),
    ascii_columns: frozenset[str] = frozenset(),
    literal_values: int = LITERAL_VALUES,
) -> Reference:
    """Freeze the domains of the reference month, or stop if that month is unusable."""
    frozen = master.where(strip(F.col(period)) == config.reference_month)
    table = staging.write(category_values(frozen, columns, ascii_columns), "reference")
    return read_reference(
        table, config, columns, staging, bands=bands, literal_values=literal_values)


def read_reference(
    table: Staged, config: JobConfig, columns: Sequence[str], staging: Staging, *,
    bands: Sequence[str] = (), literal_values: int = LITERAL_VALUES,
) -> Reference:
    """A written domain table, or stop if it came from an unusable month."""
    measured = {
        row["column"]: row
        for row in table.frame.groupBy("column")
        .agg(
            F.sum("n").alias("rows"),
            F.count("value").alias("size"),
            F.count_if(F.col("value").isNull()).alias("missing"),
            F.count_if(~F.col("value").rlike(BAND_FORM)).alias("unbanded"),
        )
        .collect()
    }
    if not measured:
        raise ValueError(f"Reference month {config.reference_month} is absent from the input")
    for column in columns:
        if measured[column]["missing"]:
            raise ValueError(f"Reference month has rows without {column}")
    for column in bands:
        if measured[column]["unbanded"]:
            raise ValueError(f"Reference month has a malformed {column}")
    sizes = {c: measured[c]["size"] for c in columns}
    short = [c for c in columns if sizes[c] <= literal_values]
    literals: dict[str, list[str]] = {c: [] for c in short}
    for row in table.frame.where(F.col("column").isin(short)).select("column", "value").collect():
        literals[row["column"]].append(row["value"])
    return Reference(
        table, staging, measured[columns[0]]["rows"], sizes, {c: sorted(v) for c, v in literals.items()}
    )


def unseen_categories(
    master: DataFrame,
    reference: Reference,
    columns: Sequence[str],
    ascii_columns: frozenset[str] = frozenset(),
) -> DataFrame:
    """``column, value, rows`` for values outside their domain; counted before the anti-join."""
    seen = category_values(master, columns, ascii_columns).where(F.col("value").isNotNull())
    return seen.join(reference.frame.drop("n"), ["column", "value"], "left_anti").select(
        "column", "value", F.col("n").alias("rows")
    )


def band_bounds(text: Column) -> tuple[Column, Column]:
    return tuple(F.regexp_extract(text, BAND_FORM, i).try_cast("int") for i in (1, 2))
