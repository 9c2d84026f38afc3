"""The stages one by one, for use as a library.

Each takes and returns DataFrames, so hand-made frames can enter anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions.identity import sha256
from siftworks.operators.dedup import refuse_collisions
from siftworks.operators.profile import column_profile
from siftworks.operators.reference import Reference
from siftworks.plans import decide as plan
from siftworks.plans.job import run_job as run_pipeline
from siftworks.presets import property_sales as sales
from siftworks.sources.csv_files import Scan, scan_csv
from siftworks.staging import Staging

__all__ = [
    "add_keys", "build_reference", "deduplicate", "detect_anomalies", "load_inputs", "profile",
    "run_pipeline", "transform", "validate",
]


def load_inputs(spark: SparkSession, folder: str, config: JobConfig, staging: Staging) -> Scan:
    return scan_csv(spark, folder, config, staging)


def build_reference(master: DataFrame, config: JobConfig, staging: Staging) -> Reference:
    return plan.learn_reference(master, config, staging, plan.ascii_text_columns(master))


def validate(
    master: DataFrame, reference: Reference, config: JobConfig, staging: Staging
) -> tuple[DataFrame, DataFrame]:
    """Typed accepted rows, and rejected rows in their original text with every reason.

    The assessed rows are staged, so that later filters do not repeat the rules.
    """
    ascii_columns = plan.ascii_text_columns(master)
    composed = plan.compose_text(master, ascii_columns, staging)
    rows = staging.write(
        sales.assess(composed, reference, config, ascii_columns=ascii_columns), "assessed"
    ).frame
    accepted = rows.where(F.col("_quarantine_stage").isNull())
    rejected = rows.where(F.col("_quarantine_stage").isNotNull()).select(
        "_raw.*", *sales.LINEAGE, "_quarantine_stage", "_quarantine_reasons"
    )
    return accepted, rejected


def add_keys(accepted: DataFrame, source_columns: Sequence[str] | None = None) -> DataFrame:
    """Add the canonical key text and its digest; stop if two keys share a digest."""
    key = sales.composite_key(accepted, source_columns)
    keyed = accepted.withColumn("_canonical_key", key).withColumn(
        "_key_hash", sha256(F.col("_canonical_key"))
    )
    refuse_collisions(keyed, "_key_hash", F.col("_canonical_key"))
    return keyed


def deduplicate(accepted: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """The best row of every key, and the others with the id of the row they lost to."""
    marked, _ = plan.with_duplicates(accepted, staging)
    return (
        marked.where(F.col("_quarantine_stage").isNull()),
        marked.where(F.col("_quarantine_stage") == "duplicate"),
    )


def detect_anomalies(
    winners: DataFrame, config: JobConfig, staging: Staging
) -> tuple[DataFrame, DataFrame]:
    """Rows within their fences or without any, and rows outside, all with evidence."""
    scored = plan.with_fences(winners, plan.price_statistics(winners, staging), config)
    return (
        scored.where(F.col("_quarantine_stage").isNull()),
        scored.where(F.col("_quarantine_stage") == "anomaly"),
    )


def transform(cleaned: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """Rows with mean and identifier, and the same rows with both digests.

    Stops at an identifier of another form and at a repeated record digest.
    """
    coded = staging.write(plan.transform(cleaned, staging), "coded").frame
    plan.refuse_bad_codes(coded)
    digests = ["resale_identifier_hash", "resale_record_hash"]
    return coded.drop(*digests), coded.drop("group_average_resale_price", "Resale Identifier")


def profile(frame: DataFrame, staging: Staging) -> DataFrame:
    return column_profile(frame, staging)
