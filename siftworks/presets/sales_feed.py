"""A property-sale feed derived from order, customer and nation tables.

Every dirty value follows from the order key, so any engine can derive the same
rows. Dirt stays out of the reference month: domains are learned from rows that
have not been validated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions.identity import record_id
from siftworks.sources.tables import read_table

FEED_CONFIG = JobConfig(
    start_month="1995-01", end_month="2001-12", reference_month="1995-01",
    registration_from="1995-03",
)
#: Approvals of values the reference month lacks, one of them given twice, and the end of one it has.
FEED_APPROVALS = (
    ("add", "town", "unknown ", "1996-05", "1997-09", "desk a"),
    ("add", "town", "UNKNOWN", "1998-02", None, "desk b"),
    ("add", "storey_range", "01 TO 05", "1997-01", None, "desk a"),
    ("end", "flat_type", "SINGLE", "1998-07", None, "desk b"),
)
FEED_NAME, FEED_DIGEST = "sales_feed", "derived"


def sales_feed(spark: SparkSession, sf_dir: str, *, supplied_term: bool = False) -> DataFrame:
    """All-text attributes with lineage; ``supplied_term`` adds ``remaining_lease``."""
    orders = read_table(
        spark, f"{sf_dir}/orders.parquet",
        ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"],
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    sold = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    k, buyer = F.col("o_orderkey"), F.col("o_custkey")
    ref = F.date_format("o_orderdate", "yyyy-MM") == FEED_CONFIG.reference_month

    def every(step: int):
        return (k % step == 0) & ~ref

    band = band_text(k)
    copy = F.explode(F.when(k % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = sold.withColumn("copy", copy)
    price = F.col("o_totalprice").cast("decimal(18,2)") - F.col("copy").cast("decimal(18,2)")
    attributes = {
        "month": F.when(every(97), "1995-13").otherwise(F.date_format("o_orderdate", "yyyy-MM")),
        "town": F.when(every(79), F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
        .when(every(101), "UNKNOWN")
        .otherwise(F.col("n_name")),
        "flat_type": F.when((k % 61 == 0) | (ref & (k % 13 == 0)), "RARE")
        .when((k % 1009 == 0) | (ref & (k % 17 == 0)), "SINGLE")
        .otherwise(F.col("c_mktsegment")),
        "block": F.when(every(103), "ABC").otherwise(
            F.concat(buyer.cast("string"), F.when((k % 7 == 0) & ~ref, "A").otherwise(""))
        ),
        "street_name": F.col("c_name"),
        "storey_range": F.when(every(83), "01 TO 05").otherwise(band),
        "floor_area_sqm": F.when(every(107), "0").otherwise((40 + k % 100).cast("string")),
        "flat_model": F.col("o_orderpriority"),
        "lease_commence_date": F.when(every(109), "2013").otherwise(
            (1960 + buyer % 30).cast("string")
        ),
        "resale_price": F.when(every(89), "-1").otherwise(
            price.cast("decimal(18,2)").cast("string")
        ),
    }
    if supplied_term:
        attributes["remaining_lease"] = supplied_term_text(k)
    row = k * 2 + F.col("copy") + 1
    return rows.select(
        *[value.alias(name) for name, value in attributes.items()],
        row.alias("_source_row"),
        F.lit(FEED_NAME).alias("_source_file"),
        F.lit(FEED_DIGEST).alias("_source_sha256"),
        record_id(F.lit(FEED_NAME), F.lit(FEED_DIGEST), row).alias("_source_record_id"),
    )


def band_text(k):
    """``%02d TO %02d`` of twelve bands, without the formatter that would be made for every row."""
    low = 3 * (k % 12) + 1

    def digits(n):
        text = n.cast("string")
        padded = F.when(n.between(0, 9), F.concat(F.lit("0"), text)).otherwise(text)
        return F.coalesce(padded, F.lit("null"))

    return F.concat(digits(low), F.lit(" TO "), digits(low + 2))


def supplied_term_text(k):
    """Terms as sources write them: years, years and months, blank, null or nonsense."""
    years = (40 + k % 70).cast("string")
    spelled = F.concat(years, F.lit(" Years "), F.lpad((k % 13).cast("string"), 2, "0"), F.lit(" months"))
    return (
        F.when(k % 6 == 0, F.lit(None).cast("string"))
        .when(k % 6 == 1, years)
        .when(k % 6 == 2, spelled)
        .when(k % 6 == 3, F.concat(F.lit(" "), years, F.lit(" year")))
        .when(k % 6 == 4, F.when(k % 5 == 0, "about 60 years").otherwise(years))
        .otherwise("")
    )
