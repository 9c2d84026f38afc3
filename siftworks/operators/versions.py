"""Category domains that change by approval: which version of a domain held in a row's month.

The values of the frozen reference month are version 0 and hold at all times. Stewards approve
further values from a month on, perhaps until another, and may end a value of version 0. Every
approval is a version of its own; of several that hold, the latest one is named.

Rows meet versions by an as-of interval join without a range join: the versions of one value
are few, so they become one array per (column, value), rows find it by equality, and the month
picks from the array. A value that fills the rows is handled as any hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.periods import MONTH_FORM, is_month
from siftworks.functions.text import is_blank, normalize_text, strip
from siftworks.operators.attach import attach
from siftworks.operators.reference import Reference
from siftworks.staging import Staged, Staging

#: Columns of a table of approvals; ``kind`` is ``add`` or ``end``.
APPROVALS = "kind string, column string, value string, valid_from string, valid_to string, approver string"
ADD, END = "add", "end"
BASE_APPROVER = "reference month"


def _faults(columns: Sequence[str]) -> dict[str, Column]:
    """What can be wrong with an approval."""
    until = F.col("valid_to")
    return {
        "kind": ~F.col("kind").isin(ADD, END),
        "column": ~F.col("column").isin(*columns),
        "value": is_blank(F.col("value")),
        "valid_from": ~F.col("valid_from").rlike(MONTH_FORM),
        "valid_to": until.isNotNull() & (~until.rlike(MONTH_FORM) | (until <= F.col("valid_from")) | (F.col("kind") == END)),
        "approver": is_blank(F.col("approver")),
    }


def check_approvals(approvals: DataFrame, columns: Sequence[str]) -> None:
    """Refuse approvals that lack something, or that come twice for one value and month."""
    faults = _faults(columns)
    counted = approvals.agg(*[
        F.count_if(F.coalesce(wrong, F.lit(True))).alias(name) for name, wrong in faults.items()
    ]).first().asDict()
    bad = {name: n for name, n in counted.items() if n}
    if bad:
        raise ValueError(f"Approvals with a bad field: {bad}")
    tidy = approvals.select("kind", "column", normalize_text(F.col("value")).alias("value"), "valid_from")
    twice = tidy.groupBy(*tidy.columns).count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError("A value is approved twice from the same month")


def domain_versions(reference: DataFrame, approvals: DataFrame) -> DataFrame:
    """column, value, valid_from, valid_to (null: open), version, approver.

    Approvals are numbered by their month, then column, value and kind. An end closes
    whatever holds for its value before its month.
    """
    tidy = approvals.select(
        "kind", "column", normalize_text(F.col("value")).alias("value"), "valid_from", "valid_to",
        strip(F.col("approver")).alias("approver"))
    place = F.struct("valid_from", "column", "value", "kind")
    # One row per approval: steward decisions, not data.
    listed = tidy.groupBy().agg(F.sort_array(F.collect_list(F.struct(
        place.alias("place"), "valid_to", "approver"))).alias("all"))
    numbered = listed.select(F.posexplode("all").alias("at", "a")).select(
        "a.place.*", "a.valid_to", "a.approver", (F.col("at") + 1).cast("int").alias("version"))
    base = reference.select(
        "column", "value", F.lit("").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"),
        F.lit(0).alias("version"), F.lit(BASE_APPROVER).alias("approver"))
    added = base.unionByName(numbered.where(F.col("kind") == ADD).drop("kind"))
    ends = numbered.where(F.col("kind") == END).groupBy("column", "value").agg(
        F.array_sort(F.collect_list("valid_from")).alias("ends"))
    closed = added.join(ends, ["column", "value"], "left")
    next_end = F.get(F.filter("ends", lambda m: m > F.col("valid_from")), 0)
    return closed.select(
        "column", "value", "valid_from",
        F.least("valid_to", next_end).alias("valid_to"), "version", "approver")


@dataclass(frozen=True)
class VersionedReference:
    """Domains by month, usable wherever the frozen reference is."""

    base: Reference
    versions: Staged
    staging: Staging
    period: str = "month"

    @property
    def frame(self) -> DataFrame:
        return self.base.frame

    @property
    def rows(self) -> int:
        return self.base.rows

    def report(self, config, table: str) -> dict:
        return {**self.base.report(config, table), "versions": "reports/reference_versions"}

    def _held(self, rows: DataFrame, column: str) -> DataFrame:
        """Add ``_sw_held``: the version that held for the row's value in its month, or null."""
        interval = F.struct("version", "valid_from", "valid_to", "approver")
        known = self.versions.frame.where(F.col("column") == column).groupBy(
            F.col("value").alias(column)).agg(F.sort_array(F.collect_list(interval), asc=False).alias("_sw_all"))
        # Weights are the rows' own counts: a value that fills them may have one version.
        counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_sw_n"))
        lookup = self.staging.write(counted.join(known, column, "left"), "versions")
        joined = attach(rows, lookup.frame, lookup, [column], spread=["_source_record_id"])
        tidy = strip(F.col(self.period))
        month = F.when(is_month(tidy), tidy).otherwise(F.lit(""))
        held = F.filter("_sw_all", lambda v: (v["valid_from"] <= month) & (v["valid_to"].isNull() | (month < v["valid_to"])))
        return joined.withColumn("_sw_held", F.get(held, 0)).drop("_sw_n", "_sw_all")

    def mark_known(self, rows: DataFrame, columns: Sequence[str], flag) -> DataFrame:
        """Add a boolean ``flag(column)`` per column: did a version hold in the row's month?"""
        for column in columns:
            rows = self._held(rows, column).withColumn(flag(column), F.col("_sw_held").isNotNull()).drop("_sw_held")
        return rows

    def name_versions(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Add ``_version_<column>`` and ``_approver_<column>``; null where no version held."""
        for column in columns:
            rows = self._held(rows, column).withColumns({
                f"_version_{column}": F.col("_sw_held.version"), f"_approver_{column}": F.col("_sw_held.approver"),
            }).drop("_sw_held")
        return rows


def with_approvals(
    reference: Reference, approvals: DataFrame, columns: Sequence[str], staging: Staging
) -> VersionedReference:
    """The frozen domains with the versions that approvals make of them."""
    check_approvals(approvals, columns)
    return VersionedReference(reference, staging.write(domain_versions(reference.frame, approvals), "approved"), staging)

