"""A stated query set against all vectors, in bounded blocks.

Vectors are dealt into shards of about ``SHARD_ROWS`` rows by a hash of their id, so
copies of one vector spread over all shards, and queries into blocks of about
``BLOCK_ROWS``. One task sees one shard and one block. Each shard returns a query's
best few; these are merged by a ranked window per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.staging import Staging

SHARD_ROWS, BLOCK_ROWS = 8_192, 4_096


def usable(vectors: DataFrame, zeros: bool) -> DataFrame:
    """vec_id, embedding, of rows with an id and a finite vector; ``zeros``: also zero ones."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    rows = vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    return rows if zeros else rows.where(F.exists("embedding", lambda x: x != 0))


def matrix(table: pa.Table) -> np.ndarray:
    column = table["embedding"].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1).astype(np.float64)


def search(
    vectors: DataFrame, is_query: Column, best: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple]],
    score: str, k: int, nearest: bool,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query over all shards.

    ``best(ids, rows, query_ids, queries)`` gives (query_id, vec_id, score) of one shard
    and one block. Only vectors of a query's length are its candidates.
    """
    stage = Staging(vectors.sparkSession).write(
        vectors, "vectors", rows=F.count(F.lit(1)), queries=F.count(F.when(is_query, 1)))
    shards = max(1, -(-(stage.metrics.get("rows") or 0) // SHARD_ROWS))
    blocks = max(1, -(-(stage.metrics.get("queries") or 0) // BLOCK_ROWS))
    rows = stage.frame.withColumn("size", F.size("embedding"))
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.withColumn("shard", deal(shards, 1)).withColumn("block", each(blocks))
    queries = rows.where(is_query).withColumn("block", deal(blocks, 2)).withColumn("shard", each(shards))
    keys = ["size", "shard", "block"]
    kind = pa.int64() if score == "long" else pa.float64()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            found = best(left["vec_id"].to_numpy(), matrix(left), right["vec_id"].to_numpy(), matrix(right))
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({
            "query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
            "score": pa.array(columns[2], kind)})

    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        run, f"query_id long, vec_id long, score {score}")
    # An id that stands in several rows counts once, with its best row.
    once = found.groupBy("query_id", "vec_id").agg((F.min if nearest else F.max)("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.asc("score") if nearest else F.desc("score"), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
