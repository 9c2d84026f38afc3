"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.catalog import evolution, odd
from siftworks.config import JobConfig
from siftworks.functions import identity, numbers, terms, text
from siftworks.operators import groups, profile, reference, reports
from siftworks.operators.dedup import duplicate_index, mark_duplicates, winners
from siftworks.operators.fences import (
    PeerLevel, attach_fences, outside_fences, peer_statistics,
)
from siftworks.plans import decide as plan
from siftworks.plans import verify
from siftworks.plans.job import key_hash, publish_run
from siftworks.presets import property_sales as sales
from siftworks.presets.sales_feed import FEED_CONFIG, sales_feed
from siftworks.sources.csv_files import scan_csv
from siftworks.sources.tables import read_table
from siftworks.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]


def _or(value, default: int):
    return F.coalesce(value, F.lit(default).cast("bigint"))


def _master(feed: DataFrame, staging: Staging) -> plan.Master:
    return plan.write_master(feed, f"{staging.root}/master")


def _assessed(
    spark: SparkSession, sf_dir: str, *columns: str, supplied_term: bool = False
) -> DataFrame:
    """The named columns of the assessed feed, staged so that filters do not repeat the rules."""
    staging = Staging(spark)
    feed = sales_feed(spark, sf_dir, supplied_term=supplied_term)
    master = _master(feed, staging)
    known = plan.learn_reference(master.frame, FEED_CONFIG, staging, master.ascii_columns)
    rows = sales.assess(master.frame, known, FEED_CONFIG, ascii_columns=master.ascii_columns)
    return staging.write(rows.select("_source_row", "_quarantine_stage", *columns), "rows").frame


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    master = _master(sales_feed(spark, sf_dir), staging)
    return plan.marked_table(master, FEED_CONFIG, staging)[0]


def _decided(
    spark: SparkSession,
    sf_dir: str,
    supplied_term: bool = False,
    staging: Staging | None = None,
) -> plan.Decisions:
    staging = staging or Staging(spark)
    feed = sales_feed(spark, sf_dir, supplied_term=supplied_term)
    return plan.decide(_master(feed, staging), FEED_CONFIG, staging)


def _transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    decided = _decided(spark, sf_dir, staging=staging)
    cleaned = staging.write(decided.cleaned, "cleaned").frame
    return plan.transform(cleaned, staging)


def quality_by_month(spark, sf_dir):
    return reports.quality_by_month(_decided(spark, sf_dir).frame)


def reference_domains(spark, sf_dir):
    staging = Staging(spark)
    master = _master(sales_feed(spark, sf_dir), staging)
    known = plan.learn_reference(master.frame, FEED_CONFIG, staging, master.ascii_columns)
    return known.frame.select("column", "value", F.col("n").alias("rows"))


def normalized_text(spark, sf_dir):
    feed = sales_feed(spark, sf_dir)
    return feed.select(
        "_source_row",
        *[text.normalize_text(F.col(c)).alias(c) for c in sales.NORMALIZED],
    )


def validation_reasons(spark, sf_dir):
    rows = _assessed(spark, sf_dir, "_quarantine_reasons")
    return rows.where(F.col("_quarantine_stage") == "validation").select(
        "_source_row", F.to_json("_quarantine_reasons").alias("quarantine_reasons")
    )


def reason_histogram(spark, sf_dir):
    return reports.reason_histogram(_decided(spark, sf_dir).frame)


def unseen_categories(spark, sf_dir):
    staging = Staging(spark)
    master = _master(sales_feed(spark, sf_dir), staging)
    known = plan.learn_reference(master.frame, FEED_CONFIG, staging, master.ascii_columns)
    return reference.unseen_categories(
        master.frame, known, sales.CATEGORIES, master.ascii_columns
    )


def scope_accounting(spark, sf_dir):
    """The feed against a scope that leaves out its first and last years."""
    config = JobConfig("1996-01", "2000-12", "1996-01")
    return reports.scope_accounting(sales_feed(spark, sf_dir), config)


def storey_bounds(spark, sf_dir):
    low, high = reference.band_bounds(F.col("storey_range"))
    feed = sales_feed(spark, sf_dir)
    return feed.select(
        "_source_row", low.cast("bigint").alias("low"), high.cast("bigint").alias("high")
    )


def money_cents(spark, sf_dir):
    feed = sales_feed(spark, sf_dir)
    return feed.select("_source_row", _or(numbers.money_cents(F.col("resale_price")), -1).alias("cents"))


def provided_duration_parse(spark, sf_dir):
    feed = sales_feed(spark, sf_dir, supplied_term=True)
    months = terms.supplied_months(F.col(sales.SUPPLIED_TERM), FEED_CONFIG.term_months)
    return feed.select("_source_row", _or(months, -1).alias("months"))


def record_ids(spark, sf_dir):
    return sales_feed(spark, sf_dir).select("_source_row", "_source_record_id")


def canonical_key_hash(spark, sf_dir):
    rows = _assessed(spark, sf_dir, "_key_hash").where(F.col("_quarantine_stage").isNull())
    return rows.select("_source_row", "_key_hash").withColumnRenamed("_key_hash", "key_hash")


def dedup_winners(spark, sf_dir):
    rows = _marked(spark, sf_dir).where(F.col("_quarantine_stage").isNull())
    return rows.select("_source_row", F.col("_price_cents").alias("price_cents"))


def dedup_losers_with_reference(spark, sf_dir):
    rows = _marked(spark, sf_dir).where(F.col("_quarantine_stage") == "duplicate")
    return rows.select(
        "_source_row", F.col("_reference_source_record_id").alias("reference_id")
    )


def dedup_lineitem(spark, sf_dir):
    rows = read_table(spark, f"{sf_dir}/lineitem.parquet").withColumn(
        "cents", F.round(F.col("l_extendedprice") * 100).cast("bigint")
    )
    rest = [
        "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate",
    ]
    best = winners(
        rows, ["l_orderkey", "l_linenumber"], [-F.col("cents"), *map(F.col, rest)],
        ["cents", "l_partkey", "l_suppkey"],
    )
    return best.withColumnRenamed("n", "copies")


def dedup_documents_text(spark, sf_dir):
    """Documents whose text and language repeat, each with the copy that is kept."""
    rows = read_table(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text", "lang"])
    key = identity.canonical_key({"text": F.col("text"), "lang": F.col("lang")})
    staging = Staging(spark)
    # Written once and narrow, so that texts are read and digested once.
    keyed = staging.write(rows.select(
        "doc_id", identity.sha256(key).alias("key_hash"), F.xxhash64(key).alias("key_mark")), "keyed").frame
    index = duplicate_index(keyed, "key_hash", F.col("key_mark"), [F.col("doc_id")], "doc_id", staging)
    marked = mark_duplicates(keyed.select("doc_id", "key_hash"), index, "key_hash", "doc_id")
    return marked.where(F.col("_reference_source_record_id").isNotNull()).select(
        "doc_id", F.col("_reference_source_record_id").alias("kept_doc_id")
    )


def _evidence():
    return [
        F.col("_anomaly_peer_level").alias("peer_level"),
        F.col("_anomaly_peer_count").alias("peer_count"),
        F.round("_anomaly_lower_ppsqm", 4).alias("lower_fence"),
        F.round("_anomaly_upper_ppsqm", 4).alias("upper_fence"),
    ]


def price_fences(spark, sf_dir):
    rows = _decided(spark, sf_dir).frame
    return rows.where(F.col("_anomaly_peer_level").isNotNull()).select("_source_row", *_evidence())


def peer_level_counts(spark, sf_dir):
    return reports.peer_level_counts(_decided(spark, sf_dir).frame)


def anomaly_rows(spark, sf_dir):
    rows = _decided(spark, sf_dir).frame.where(F.col("_quarantine_stage") == "anomaly")
    return rows.select(
        "_source_row", "price_per_sqm", *_evidence()
    )


def event_value_fences(spark, sf_dir):
    """Events outside the fences of their type and day, or of their type."""
    events = read_table(spark, f"{sf_dir}/events.parquet", ["event_id", "ts", "event_type", "value"])
    events = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    levels = (PeerLevel("type_day", ("event_type", "day")), PeerLevel("type", ("event_type",)))
    statistics = peer_statistics(events, "value", levels, Staging(spark))
    scored = attach_fences(
        events, statistics, "value", levels, min_peers=20, multiplier=3.0, spread=["event_id"]
    )
    return scored.where(outside_fences(F.col("value"))).select("event_id", *_evidence())


def remaining_term(spark, sf_dir):
    columns = [
        "remaining_lease_total_months", "remaining_lease_years", "remaining_lease_months",
        "remaining_lease_years_months",
    ]
    rows = _assessed(spark, sf_dir, *columns).where(F.col("_quarantine_stage").isNull())
    return rows.select("_source_row", *columns)


def unit_price(spark, sf_dir):
    rows = _assessed(
        spark, sf_dir, "transaction_year", "transaction_month", "_date_basis", "price_per_sqm"
    ).where(F.col("_quarantine_stage").isNull())
    return rows.select(
        "_source_row", "transaction_year", "transaction_month",
        F.col("_date_basis").alias("date_basis"),
        "price_per_sqm",
    )


def term_comparison(spark, sf_dir):
    rows = _assessed(
        spark, sf_dir, "_provided_lease_months", "_provided_lease_difference_months",
        "_lease_comparison_note", supplied_term=True,
    )
    return rows.where(F.col("_quarantine_stage").isNull()).select(
        "_source_row",
        _or(F.col("_provided_lease_months"), -1).alias("provided_months"),
        _or(F.col("_provided_lease_difference_months"), 0).alias("difference_months"),
        F.col("_lease_comparison_note").alias("note"),
    )


def lease_review(spark, sf_dir):
    rows = reports.lease_review_rows(_decided(spark, sf_dir, supplied_term=True).frame)
    return rows.select(
        "_source_row", F.col("_provided_lease_difference_months").alias("difference_months")
    )


def group_average(spark, sf_dir):
    return _transformed(spark, sf_dir).select(
        "_source_row", F.col("group_average_resale_price").alias("group_average")
    )


def business_identifier(spark, sf_dir):
    return _transformed(spark, sf_dir).select(
        "_source_row", F.col("Resale Identifier").alias("identifier")
    )


def hashed_records(spark, sf_dir):
    return _transformed(spark, sf_dir).select(
        "_source_row", "resale_identifier_hash", "resale_record_hash"
    )


def identifier_collisions(spark, sf_dir):
    counts = groups.code_counts(_transformed(spark, sf_dir), "Resale Identifier")
    return groups.collision_statistics(counts)


def identifier_collision_rows(spark, sf_dir):
    staging = Staging(spark)
    coded = staging.write(
        _transformed(spark, sf_dir).select("_source_row", "Resale Identifier"), "coded"
    ).frame
    shared = groups.rows_sharing_code(coded, "Resale Identifier", staging, ["_source_row"])
    return shared.select(
        "_source_row", F.col("Resale Identifier").alias("identifier"), F.col("_sw_n").alias("copies")
    )


def decision_counts(spark, sf_dir):
    return reports.decision_counts(_decided(spark, sf_dir).frame)


def review_sample(spark, sf_dir):
    """The first twenty quarantined rows in lineage order."""
    rows = reports.review_sample(_decided(spark, sf_dir).quarantined, 20)
    return rows.select(
        "_source_row", F.col("_raw.month").alias("month"), F.col("_raw.town").alias("town"),
        F.col("_quarantine_stage").alias("stage"),
        F.to_json("_quarantine_reasons").alias("quarantine_reasons"),
    )


def numeric_describe(spark, sf_dir):
    orders = read_table(spark, f"{sf_dir}/orders.parquet", ["o_custkey", "o_totalprice"])
    described = profile.numeric_describe(orders, ["o_custkey", "o_totalprice"], Staging(spark))
    numbers_ = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return described.select(
        "column", F.col("numeric_parseable_count").alias("count"),
        *[F.round(c, 4).alias(c) for c in numbers_],
    )


def top_values(spark, sf_dir):
    customer = read_table(spark, f"{sf_dir}/customer.parquet", ["c_mktsegment", "c_nationkey"])
    counts = profile.value_counts(customer, customer.columns)
    return profile.top_values(counts).select(
        "column", F.col("rank").cast("bigint").alias("rank"), "value", F.col("n").alias("rows")
    )


def column_profile(spark, sf_dir):
    feed = sales_feed(spark, sf_dir, supplied_term=True)
    staging = Staging(spark)
    columns = sales.source_columns(feed)
    rows = staging.write(feed.select(*columns), "profiled").frame
    profiled = profile.column_profile(rows, staging)
    return profiled.select(
        "column", "rows", "missing", "missing_pct", "distinct_non_null",
        F.coalesce("numeric_parseable_count", F.lit(0).cast("bigint")).alias("parseable"),
        F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        F.round("p50", 4).alias("p50"),
        F.get("top_values", 0)["value"].alias("top_value"),
        _or(F.get("top_values", 0)["n"], 0).alias("top_rows"),
    )


def conservation(spark, sf_dir):
    """How often each master row is kept or rejected, summed over all rows."""
    decisions = _decided(spark, sf_dir).frame
    kept = F.col("_quarantine_stage").isNull()
    per_row = decisions.groupBy("_source_record_id").agg(
        F.count_if(kept).alias("kept"), F.count_if(~kept).alias("rejected")
    )
    return per_row.agg(
        F.count(F.lit(1)).alias("master_ids"),
        F.sum("kept").alias("kept_rows"),
        F.sum("rejected").alias("rejected_rows"),
        F.count_if(F.col("kept") + F.col("rejected") != 1).alias("violations"),
    )


def _feed_as_csv(spark: SparkSession, sf_dir: str, staging: Staging) -> str:
    """The feed as CSV files, one folder per year."""
    feed = sales_feed(spark, sf_dir)
    rows = feed.select(*sales.source_columns(feed), F.substring("month", 1, 4).alias("feed_year"))
    folder = f"{staging.root}/csv"
    (
        rows.hint("rebalance", "feed_year")
        .write.partitionBy("feed_year")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return folder


def _feed_year(file: str):
    return F.regexp_extract(file, "feed_year=([0-9]+)/", 1).alias("feed_year")


def source_inventory(spark, sf_dir):
    """Inventory of the feed written as CSV files, summed per year folder."""
    staging = Staging(spark)
    folder = _feed_as_csv(spark, sf_dir, staging)
    scan = scan_csv(spark, folder, FEED_CONFIG, staging, recursive=True)
    return scan.inventory.groupBy(_feed_year("file")).agg(
        *[F.sum(c).alias(c) for c in ("rows", "in_scope_rows", "invalid_date_rows", "out_of_scope_rows")],
        F.min("min_month").alias("min_month"),
        F.max("max_month").alias("max_month"),
    )


def csv_row_lineage(spark, sf_dir):
    """Rows, last row numbers and distinct row numbers per year folder of CSV files."""
    staging = Staging(spark)
    folder = _feed_as_csv(spark, sf_dir, staging)
    config = JobConfig("1900-01", "2100-12", "1995-01")
    master = scan_csv(spark, folder, config, staging, recursive=True).master
    per_file = master.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("_source_row").alias("last"),
        F.count_distinct("_source_row").alias("different"),
    )
    return per_file.groupBy(_feed_year("_source_file")).agg(
        F.sum("n").alias("rows"), F.sum("last").alias("last_rows"),
        F.sum("different").alias("different_rows"),
    )


def contract_checks(spark, sf_dir):
    """Publish the feed's decisions and check the published files."""
    staging = Staging(spark)
    published = publish_run(
        spark, sales_feed(spark, sf_dir), FEED_CONFIG, f"{staging.root}/run", staging
    )
    # The checks read published files only.
    published.decisions.drop()
    return verify.contract_checks(
        spark, published.run, published.columns, published.reference, FEED_CONFIG,
        key_hash(published.columns),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        quality_by_month, reference_domains, normalized_text, validation_reasons,
        reason_histogram, unseen_categories, scope_accounting, storey_bounds, money_cents,
        provided_duration_parse, record_ids, canonical_key_hash, dedup_winners,
        dedup_losers_with_reference, dedup_lineitem, dedup_documents_text, price_fences,
        peer_level_counts, anomaly_rows, event_value_fences, remaining_term, unit_price,
        term_comparison, lease_review, group_average, business_identifier, hashed_records,
        identifier_collisions, identifier_collision_rows, decision_counts, review_sample,
        numeric_describe, top_values, column_profile, conservation, source_inventory,
        csv_row_lineage, contract_checks,
    )
} | evolution.QUERIES | odd.QUERIES
