"""From a master table to one terminal decision per row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions.identity import BUSINESS_CODE_FORM, sha256
from siftworks.functions.text import has_non_ascii, nfkc
from siftworks.operators.attach import attach, fits_broadcast
from siftworks.operators.dedup import duplicate_index, mark_duplicates, marks_fit
from siftworks.operators.fences import attach_fences, outside_fences, peer_statistics
from siftworks.operators.groups import attach_mean, cent_sums
from siftworks.operators.reference import Reference, build_reference
from siftworks.operators.versions import VersionedReference, with_approvals
from siftworks.presets import property_sales as sales
from siftworks.staging import DENSE, Staged, Staging, write_observed

ROW_ID = "_source_record_id"
# Where at most one row in so many has a repeated key, marking them again costs less than a copy of all rows.
FEW_COPIES = 8


def _ascii_measures(master: DataFrame) -> dict[str, Column]:
    present = [c for c in sales.NORMALIZED if c in master.columns]
    return {c: F.count_if(has_non_ascii(F.col(c))) for c in present}


def ascii_text_columns(master: DataFrame) -> frozenset[str]:
    """The normalised columns that hold ASCII only, measured over every row."""
    row = master.agg(*[m.alias(c) for c, m in _ascii_measures(master).items()]).first()
    return frozenset(c for c, n in row.asDict().items() if not n)


@dataclass(frozen=True)
class Master:
    """The written master table and the text columns its write found to be ASCII."""

    table: Staged
    ascii_columns: frozenset[str]

    @property
    def frame(self) -> DataFrame:
        return self.table.frame


def write_master(rows: DataFrame, path: str, codec: str = DENSE) -> Master:
    """Write the master table; its text is inspected in the same pass."""
    table = write_observed(rows, path, codec, rows=F.count(F.lit(1)), **_ascii_measures(rows))
    found = {c: n for c, n in table.metrics.items() if c != "rows"}
    return Master(table, frozenset(c for c, n in found.items() if not n))


def compose_text(
    rows: DataFrame, ascii_columns: frozenset[str], staging: Staging, **options
) -> DataFrame:
    """Add ``_composed_<column>`` where a normalised column holds more than ASCII.

    Only the distinct values that need it are composed in Python; rows get them back by a join
    in which ASCII rows take no part.
    """
    for column in sales.NORMALIZED:
        if column not in rows.columns or column in ascii_columns:
            continue
        odd = has_non_ascii(F.col(column))
        values = rows.where(odd).groupBy(column).agg(F.count(F.lit(1)).alias("_sw_n"))
        known = staging.write(values.withColumn("_sw_text", nfkc(F.col(column))), "composed")
        joined = attach(
            rows, known.frame, known, [column], spread=[ROW_ID], active=odd, **options)
        rows = joined.withColumn(
            sales.composed(column), F.coalesce("_sw_text", F.col(column))).drop("_sw_n", "_sw_text")
    return rows


def tidy_text(master: Master, staging: Staging) -> DataFrame:
    """Master rows with their originals in ``_raw`` and tidy text in place of it."""
    rows = compose_text(master.frame, master.ascii_columns, staging)
    return sales.clean_text(rows, sales.source_columns(master.frame), master.ascii_columns)


def learn_reference(
    master: DataFrame, config: JobConfig, staging: Staging, ascii_columns: frozenset[str],
    approvals: DataFrame | None = None,
) -> Reference | VersionedReference:
    """The domains of the reference month; with ``approvals``, their versions by month."""
    frozen = build_reference(
        master, config, sales.CATEGORIES, staging, bands=sales.BANDS, ascii_columns=ascii_columns
    )
    return frozen if approvals is None else with_approvals(frozen, approvals, sales.CATEGORIES, staging)


def with_duplicates(assessed: DataFrame, staging: Staging, **options) -> tuple[DataFrame, Staged]:
    """Mark every valid row that loses to a better copy of the same key."""
    live = assessed.where(F.col("_quarantine_stage").isNull())
    index = duplicate_index(
        live, "_key_hash", sales.composite_key(live), sales.best_first(), ROW_ID, staging
    )
    marked = mark_duplicates(
        assessed, index, "_key_hash", ROW_ID,
        active=F.col("_quarantine_stage").isNull(), **options,
    )
    loses = F.col("_reference_source_record_id").isNotNull()
    return marked.withColumns({
        "_quarantine_stage": F.when(loses, "duplicate").otherwise(F.col("_quarantine_stage")),
        "_quarantine_reasons": F.when(
            loses, F.array(F.lit(sales.DUPLICATE_REASON))
        ).otherwise(F.col("_quarantine_reasons")),
    }), index


def price_statistics(marked: DataFrame, staging: Staging) -> Staged:
    live = marked.where(F.col("_quarantine_stage").isNull())
    return peer_statistics(live, "price_per_sqm", sales.PEER_LEVELS, staging)


def with_fences(
    marked: DataFrame, statistics: Staged, config: JobConfig, **options
) -> DataFrame:
    """Add fence evidence to the rows still alive and quarantine those outside."""
    live = F.col("_quarantine_stage").isNull()
    scored = attach_fences(
        marked, statistics, "price_per_sqm", sales.PEER_LEVELS,
        min_peers=config.anomaly_min_peers, multiplier=config.anomaly_iqr_multiplier,
        spread=[ROW_ID], active=live, **options,
    )
    flagged = live & outside_fences(F.col("price_per_sqm"))
    return scored.withColumns({
        "_quarantine_stage": F.when(flagged, "anomaly").otherwise(F.col("_quarantine_stage")),
        "_quarantine_reasons": F.when(
            flagged, F.array(F.lit(sales.ANOMALY_REASON))
        ).otherwise(F.col("_quarantine_reasons")),
    })


@dataclass(frozen=True)
class Decisions:
    """The decision table and the small tables it was built from; ``rows`` is what it reads."""

    frame: DataFrame
    reference: Reference | VersionedReference
    duplicates: Staged
    statistics: Staged
    rows: Staged

    def staged(self, staging: Staging, name: str) -> Staged:
        """The decision table, written; what it was read from is removed and ``frame`` is spent."""
        written = staging.write_wide(self.frame, name)
        self.rows.drop()
        return written

    @property
    def cleaned(self) -> DataFrame:
        return self.frame.where(F.col("_quarantine_stage").isNull())

    @property
    def quarantined(self) -> DataFrame:
        return self.frame.where(F.col("_quarantine_stage").isNotNull())


def assessed_table(
    master: Master, config: JobConfig, staging: Staging, approvals: DataFrame | None = None
) -> tuple[Staged, Reference]:
    """Stage the assessed rows: the several passes that follow read pruned columns of it."""
    ascii_columns = master.ascii_columns
    reference = learn_reference(master.frame, config, staging, ascii_columns, approvals)
    composed = compose_text(master.frame, ascii_columns, staging)
    rows = sales.assess(composed, reference, config, ascii_columns=ascii_columns)
    return staging.write_wide(rows, "assessed"), reference


def marked_table(
    master: Master, config: JobConfig, staging: Staging, approvals: DataFrame | None = None,
    *, drop_master: bool = False,
) -> tuple[DataFrame, Reference, Staged, Staged]:
    """Marked rows, the reference, the duplicates and the table that the marked rows are read from."""
    assessed, reference = assessed_table(master, config, staging, approvals)
    if drop_master:
        master.table.drop()
    marked, duplicates = with_duplicates(assessed.frame, staging)
    if not fits_broadcast(duplicates) and not _few_copies(duplicates, assessed):
        # Marking took a shuffle of all rows; later passes should not repeat it.
        whole = staging.write_wide(marked, "marked")
        assessed.drop()
        return whole.frame, reference, duplicates, whole
    return marked, reference, duplicates, assessed


def _few_copies(duplicates: Staged, assessed: Staged) -> bool:
    copies = duplicates.frame.agg(F.sum("_sw_n")).first()[0] or 0
    return marks_fit(duplicates) and copies * FEW_COPIES <= assessed.rows


def decide(
    master: Master, config: JobConfig, staging: Staging, approvals: DataFrame | None = None,
    *, drop_master: bool = False,
) -> Decisions:
    """One decision for each master row; a master that nothing reads later may be dropped on the way."""
    marked, reference, duplicates, rows = marked_table(
        master, config, staging, approvals, drop_master=drop_master)
    statistics = price_statistics(marked, staging)
    return Decisions(
        with_fences(marked, statistics, config), reference, duplicates, statistics, rows
    )


def transform(cleaned: DataFrame, staging: Staging) -> DataFrame:
    """Add the group mean, the business identifier and both digests to cleaned rows."""
    return _transformed(cleaned, cent_sums(cleaned, sales.MEAN_KEYS, "_price_cents", staging))


def _transformed(cleaned: DataFrame, sums: Staged) -> DataFrame:
    averaged = attach_mean(
        cleaned, sums, sales.MEAN_KEYS, mean="group_average_resale_price", whole="_whole_units",
        spread=[ROW_ID],
    )
    coded = averaged.withColumn("Resale Identifier", sales.identifier("_whole_units"))
    return coded.withColumns({
        "resale_identifier_hash": sha256(F.col("Resale Identifier")),
        "resale_record_hash": F.col("_key_hash"),
    }).drop("_whole_units")


def coded_rows(cleaned: DataFrame, staging: Staging) -> DataFrame:
    """:func:`transform`, cheap to read again: staged only if the means took a shuffle of the rows."""
    sums = cent_sums(cleaned, sales.MEAN_KEYS, "_price_cents", staging)
    coded = _transformed(cleaned, sums)
    return coded if fits_broadcast(sums) else staging.write_wide(coded, "coded").frame


def malformed_identifiers(transformed: DataFrame) -> DataFrame:
    good = F.col("Resale Identifier").rlike(BUSINESS_CODE_FORM)
    return transformed.where(~F.coalesce(good, F.lit(False)))


def refuse_bad_codes(coded: DataFrame) -> None:
    """Stop at a malformed business identifier or at a record digest that occurs twice."""
    if not malformed_identifiers(coded).isEmpty():
        raise RuntimeError("A business identifier does not have the prescribed format")
    repeated = coded.groupBy("resale_record_hash").agg(F.count(F.lit(1)).alias("_sw_n"))
    if not repeated.where(F.col("_sw_n") > 1).isEmpty():
        raise RuntimeError("Record hashes are not unique; publication stopped")
