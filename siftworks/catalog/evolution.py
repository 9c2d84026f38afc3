"""Queries about change: refreshed months, versioned domains, runs against a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions.identity import record_id
from siftworks.operators import drift
from siftworks.operators.versions import APPROVALS
from siftworks.plans import baseline
from siftworks.plans import decide as plan
from siftworks.plans import incremental
from siftworks.presets import property_sales as sales
from siftworks.presets.sales_feed import FEED_APPROVALS, FEED_CONFIG, FEED_DIGEST, FEED_NAME, sales_feed
from siftworks.staging import Staging, shared_folder, spent_shuffles

#: Months of the feed that an earlier delivery had otherwise.
CHANGED_MONTHS = ("1997-03", "1998-05")


def _delivered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An earlier feed, and the rows that came and went since: lacking, mispriced and extra rows."""
    feed = sales_feed(spark, sf_dir)
    kind = F.floor((F.col("_source_row") - 1) / 2) % 5
    inside = F.col("month").isin(*CHANGED_MONTHS)
    repriced = feed.withColumn("resale_price", F.when(inside & (kind == 1), "1000.00").otherwise(F.col("resale_price")))
    row = -F.col("_source_row")
    extra = feed.where(inside & (kind == 2)).withColumn("resale_price", F.lit("900000.00")).withColumns({
        "_source_row": row, "_source_record_id": record_id(F.lit(FEED_NAME), F.lit(FEED_DIGEST), row)})
    earlier = repriced.where(~inside | (kind != 0)).unionByName(extra)
    added = feed.where(inside & (kind <= 1))
    removed = feed.where(inside & (kind == 1)).unionByName(extra).select("_source_record_id", "month")
    return earlier, added, removed


def _refreshed(spark: SparkSession, sf_dir: str) -> incremental.Snapshot:
    import uuid

    earlier, added, removed = _delivered(spark, sf_dir)
    root = f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}"
    incremental.build(spark, earlier, FEED_CONFIG, root)
    return incremental.refresh(spark, root, added, removed)


def incremental_refresh(spark, sf_dir):
    """Every row of the feed after its changed months were delivered again."""
    return _refreshed(spark, sf_dir).rows().select(
        "_source_row", F.coalesce("_quarantine_stage", F.lit("cleaned")).alias("stage"),
        F.to_json("_quarantine_reasons").alias("reasons"),
        F.col("_reference_source_record_id").alias("reference_id"),
        F.col("_anomaly_peer_level").alias("peer_level"), F.col("_anomaly_peer_count").alias("peer_count"),
        F.round("_anomaly_lower_ppsqm", 4).alias("lower_fence"),
        F.round("_anomaly_upper_ppsqm", 4).alias("upper_fence"),
        F.col("group_average_resale_price").alias("group_average"),
        F.col("Resale Identifier").alias("identifier"), F.col("resale_record_hash").alias("record_hash"),
    )


def incremental_months(spark, sf_dir):
    """Which months the refresh wrote again, and their rows."""
    snapshot = _refreshed(spark, sf_dir)
    counted = snapshot.rows().groupBy(F.col(incremental.PARTITION).alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("rewritten", F.col("month").isin(snapshot.rewritten))


def reference_as_of(spark, sf_dir):
    """The domain version that held for every value in its month, its approver, and what then fails."""
    staging = Staging(spark)
    master = plan.write_master(sales_feed(spark, sf_dir), f"{staging.root}/master")
    approvals = spark.createDataFrame(list(FEED_APPROVALS), APPROVALS)
    known = plan.learn_reference(master.frame, FEED_CONFIG, staging, master.ascii_columns, approvals)
    rows = sales.clean_text(master.frame, sales.source_columns(master.frame), master.ascii_columns)
    named = known.name_versions(rows, sales.CATEGORIES)
    judged = sales.assess(master.frame, known, FEED_CONFIG, ascii_columns=master.ascii_columns)
    reasons = judged.select("_source_record_id", F.to_json("_quarantine_reasons").alias("reasons"))
    return named.join(reasons, "_source_record_id").select(
        "_source_row", *[f"_version_{c}" for c in sales.CATEGORIES], *[f"_approver_{c}" for c in sales.CATEGORIES],
        "reasons")


def _measured(feed: DataFrame) -> list[DataFrame]:
    return _measured_with(feed, FEED_CONFIG)


def _measured_with(feed: DataFrame, config: JobConfig) -> list[DataFrame]:
    """The measures of a decided feed, written; the rows they were taken of are not kept."""
    spark = feed.sparkSession
    staging, measures = Staging(spark), Staging(spark)
    with spent_shuffles(spark):
        master = plan.write_master(feed, f"{staging.root}/master")
        decided = plan.decide(master, config, staging, drop_master=True).staged(staging, "decided")
        found = [measures.write(m, "measured").frame for m in baseline.measure(decided.frame)]
        staging.drop()
    return found


def _gate(before: DataFrame, after: DataFrame) -> DataFrame:
    (old_values, old_rates), (new_values, new_rates) = _measured(before), _measured(after)
    checks = drift.gate(old_values, new_values, old_rates, new_rates, drift.Thresholds())
    return checks.select(
        "check", *[F.round(c, 6).alias(c) for c in ("before", "after", "statistic")], "limit", "passed")


def baseline_gate(spark, sf_dir):
    """The feed against its earlier delivery, as a baseline."""
    return _gate(_delivered(spark, sf_dir)[0], sales_feed(spark, sf_dir))


def baseline_gate_drifted(spark, sf_dir):
    """A feed with other flat types and lost prices, which its baseline does not let pass."""
    feed = sales_feed(spark, sf_dir)
    k = F.floor((F.col("_source_row") - 1) / 2)
    drifted = feed.withColumns({
        "flat_type": F.when(k % 4 == 0, "RARE").otherwise(F.col("flat_type")),
        "resale_price": F.when(k % 6 == 1, " ").otherwise(F.col("resale_price")),
    })
    return _gate(feed, drifted)


QUERIES = {f.__name__: f for f in (
    incremental_refresh, incremental_months, reference_as_of, baseline_gate, baseline_gate_drifted,
)}
