"""Parquet tables as inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.functions.identity import record_id


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table, pruned to ``columns``."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_with_lineage(spark: SparkSession, path: str, digest: str) -> DataFrame:
    """A Parquet table with file, data row and record id from the file metadata."""
    table = spark.read.parquet(path)
    row = F.col("_metadata.row_index") + 1
    return table.select(
        "*",
        row.alias("_source_row"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.lit(digest).alias("_source_sha256"),
    ).withColumn(
        "_source_record_id",
        record_id(F.col("_source_file"), F.col("_source_sha256"), F.col("_source_row")),
    )
