"""One deterministic winner per canonical key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.operators.attach import attach, fits_broadcast
from siftworks.staging import Staged, Staging


# Repeated keys whose 64-bit marks, 8 bytes each, are broadcast to set rows of other keys aside.
MARK_ROWS = 2_000_000


class HashCollision(RuntimeError):
    """Two different keys share a digest."""


def duplicate_index(
    rows: DataFrame,
    key_hash: str,
    key: Column,
    order: Sequence[Column],
    row_id: str,
    staging: Staging,
) -> Staged:
    """Staged table of the repeated keys: ``key_hash``, ``_sw_n`` and ``_sw_winner``.

    ``order`` lists ascending sort expressions that make a total order; the
    first row wins. Keys are counted first, in a hash table of numbers: nearly all
    occur once and are done. Only rows of repeated keys are ranked. Copies are
    combined before each shuffle, so a key holding most of the rows costs one row
    per map task. A second, unrelated hash of the key shows when two keys share
    ``key_hash``, without shuffling the keys.
    """
    witness = F.xxhash64(key).alias("_witness")
    counted = rows.select(key_hash, witness).groupBy(key_hash).agg(
        F.count(F.lit(1)).alias("_sw_n"),
        F.min("_witness").alias("_sw_low"), F.max("_witness").alias("_sw_high"),
    )
    repeated = staging.write(
        counted.where(F.col("_sw_n") > 1), "repeated", collisions=F.count_if(F.col("_sw_low") != F.col("_sw_high")))
    if repeated.metrics["collisions"]:
        raise HashCollision("Different composite keys share a SHA-256 digest")
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(row_id).alias("id")).alias("_sw_rank")
    narrow = rows.select(key_hash, rank, F.xxhash64(row_id).alias("_sw_spread"))
    lookup = repeated.frame.select(key_hash, "_sw_n")
    copies = attach(narrow, lookup, repeated, [key_hash], spread=["_sw_spread"]).where(F.col("_sw_n").isNotNull())
    ranked = staging.write(copies.groupBy(key_hash).agg(
        F.max("_sw_n").alias("_sw_n"), F.min("_sw_rank")["id"].alias("_sw_winner")), "duplicates")
    repeated.drop()
    return ranked


def marks_fit(index: Staged) -> bool:
    return not fits_broadcast(index) and index.rows <= MARK_ROWS


def mark_duplicates(
    rows: DataFrame,
    index: Staged,
    key_hash: str,
    row_id: str,
    *,
    active: Column | None = None,
    **options,
) -> DataFrame:
    """Add ``_reference_source_record_id``: the winner's id on losing rows, else null.

    Where the index is too large to be broadcast but marks of its keys are not, rows without
    such a mark, which have a key that occurs once, stay in their tasks; ``rows`` is read twice then.
    """
    if options.get("broadcast_whole") is None and marks_fit(index):
        marks = F.broadcast(index.frame.select(F.xxhash64(key_hash).alias("_sw_mark")))
        marked = F.xxhash64(key_hash) == F.col("_sw_mark")
        repeated = rows.join(marks, marked, "left_semi")
        single = rows.join(marks, marked, "left_anti")
        none = F.lit(None).cast(index.frame.schema["_sw_winner"].dataType)
        return _marked(repeated, index, key_hash, row_id, active, options).unionByName(
            single.withColumn("_reference_source_record_id", none))
    return _marked(rows, index, key_hash, row_id, active, options)


def _marked(
    rows: DataFrame, index: Staged, key_hash: str, row_id: str, active: Column | None, options: dict
) -> DataFrame:
    marked = attach(
        rows, index.frame.select(key_hash, "_sw_n", "_sw_winner"), index, [key_hash], spread=[row_id],
        active=active, **options,
    )
    loses = F.col("_sw_winner") != F.col(row_id)
    return marked.withColumn(
        "_reference_source_record_id", F.when(loses, F.col("_sw_winner"))
    ).drop("_sw_n", "_sw_winner")


def refuse_collisions(rows: DataFrame, key_hash: str, key: Column) -> None:
    """Stop if two different keys share ``key_hash``; one count per digest is shuffled."""
    seen = rows.select(F.col(key_hash).alias("h"), F.xxhash64(key).alias("w")).groupBy("h").agg(
        F.min("w").alias("low"), F.max("w").alias("high")
    )
    if not seen.where(F.col("low") != F.col("high")).isEmpty():
        raise HashCollision("Different composite keys share a SHA-256 digest")


def winners(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """The first row per key, as ``keys``, ``columns`` and the number of copies ``n``."""
    rank = F.struct(
        *[c.alias(f"o{i}") for i, c in enumerate(order)], F.struct(*columns).alias("row")
    )
    best = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(rank)["row"].alias("row"))
    return best.select(*keys, "row.*", "n")
