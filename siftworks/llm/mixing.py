"""Mixing sources to target weights: capped water-filling and seeded repetition.

Weights share a word total among the sources. A source stops at ``max_epochs``
times its size; what it can't take is shared again by weight until no source is
above its cap. That end state has a closed form: with the sources sorted by cap
over weight, the capped ones are a prefix, and running sums give the water level.

A source that takes 1.4 epochs takes every document once and a seeded 0.4 of its
words again. Each row has a 48-bit number from the seed, its id and its text, and, to
part equal rows, another from its place in the table. Passes of ``CLASSES`` counted
classes a source find the two numbers up to which rows are taken, digit by digit, so the
words taken miss the target by at most half a document. No pass holds or sorts a source's
rows; from the third on they read only the rows that share the digits found so far.

Results for odd input: a null or blank text has size 0 and is mixed like others;
a null source is a source of its own, last in order; rows with null or repeated ids are
chosen by their texts, and of rows equal in both as many are taken as the target asks for,
any of them; an empty table gives an empty one. ``mix`` reads no other columns; ``repeat``
carries them, whatever their names, but for names that begin with ``_sw_``, which it refuses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.functions.naming import col
from siftworks.llm.common import WORD, staged

#: Digits of each of a row's two numbers, their bits, and the classes a pass counts.
LEVELS, BITS = 4, 12
CLASSES = 1 << BITS
#: Passes over all rows; later ones read what shares these digits.
WIDE = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, text: Column, seed: str) -> Column:
    """A number below 2**48 from a row's id, its text and the seed."""
    parts = [F.coalesce(c, F.lit("null")) for c in (key.cast("string"), F.md5(text.cast("binary")))]
    mark = F.concat(F.lit(seed + ":"), parts[0], F.lit(":"), parts[1])
    return F.conv(F.substring(F.md5(mark.cast("binary")), 1, 12), 16, 10).cast("long")


def place() -> Column:
    """A number below 2**48 from a row's place in the table, which parts equal rows."""
    return F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - LEVELS * BITS)


def weighted(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources by code point, null last, with weights that repeat. One row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    names = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(names, (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, total: Column, max_epochs: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): capped shares of ``total``.

    In order of cap over weight, source k is capped when the level that remains
    after capping all before it reaches its own cap. The first source that is not sets
    the level of all others; the levels after it, as if it were capped, are lower.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    order = Window.orderBy(F.col("_ratio"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        sources.withColumn("_cap", cap).withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_level", level)
        .withColumn("_capped", F.col("_ratio") <= F.col("_level"))
        .withColumn("_final", F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything))
        .withColumn("target", F.when(F.col("_capped"), F.col("_cap"))
                    .otherwise(F.col("weight") * F.col("_final")))
        .select("source", "source_size", "weight", "target")
    )


def _digits(level: int) -> tuple[Column, Column]:
    """Of a row: the digit at a level, and whether it shares all digits found before."""
    shift = BITS * (LEVELS - 1 - level % LEVELS)
    number, prefix = ("_draw", "_prefix") if level < LEVELS else ("_place", "_at")
    inside = F.shiftright(number, shift + BITS) == F.col(prefix)
    if level >= LEVELS:
        inside = inside & (F.col("_draw") == F.col("_prefix"))
    return F.shiftright(number, shift).bitwiseAND(CLASSES - 1), inside


def _with_state(rows: DataFrame, state: DataFrame) -> DataFrame:
    return rows.join(state, F.col("_source").eqNullSafe(F.col("source")))


def _boundary(rows: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Narrow each source's boundary by one digit of the rows' numbers.

    ``state`` has the words still wanted (``_want``) among rows whose numbers start
    with ``_prefix`` and ``_at``. The digit at which the running sum passes the want is
    the next one; smaller digits are taken whole.
    """
    digit, inside = _digits(level)
    sums = (
        _with_state(rows, state).where(inside)
        .groupBy("source", digit.alias("_digit")).agg(F.sum("size").alias("_sum"))
    )
    order = Window.partitionBy("source").orderBy("_digit")
    running = F.sum("_sum").over(order)
    last = level == 2 * LEVELS - 1
    at = (
        state.join(sums.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
        .withColumn("_sum", F.coalesce("_sum", F.lit(0)))
        .withColumn("_before", running - F.col("_sum"))
        # The last digit also goes in if that brings the sum nearer to the want.
        .withColumn("_whole", F.col("_before") + F.col("_sum") * F.lit(0.5 if last else 1.0) <= F.col("_want"))
        .groupBy("source", "_prefix", "_at", "_want")
        .agg(F.min(F.when(~F.col("_whole"), F.col("_digit"))).alias("_next"),
             F.sum(F.when(F.col("_whole"), F.col("_sum")).otherwise(0)).alias("_taken"))
    )
    longer = F.col("_prefix" if level < LEVELS else "_at") * CLASSES + F.coalesce(F.col("_next"), F.lit(CLASSES))
    return at.select(
        "source", (longer if level < LEVELS else F.col("_prefix")).alias("_prefix"),
        (longer if level >= LEVELS else F.col("_at")).alias("_at"),
        (F.col("_want") - F.col("_taken")).alias("_want"),
    )


def plan(
    documents: DataFrame, total_share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1),
    max_epochs: float = 2.0, seed: str = "mix-1", id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, _source, size, _draw, _place), and per source its target, whole epochs and boundary."""
    rows = staged(documents.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("_source"),
        word_count(F.col(text_col)).alias("size"), draw(F.col(id_col), F.col(text_col), seed).alias("_draw"),
        place().alias("_place"),
    ), "sizes")
    sources = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = weighted(sources, weights).withColumn("_total", F.sum("source_size").over(everything) * total_share)
    targets = staged(water_fill(shared, F.col("_total"), max_epochs), "targets")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = targets.withColumn("_epochs", F.floor(epochs + 1e-12)).withColumn(
        "_want", F.greatest(F.col("target") - F.col("_epochs") * F.col("source_size"), F.lit(0.0)))
    none = F.lit(0).cast("long")
    state, left = shares.select("source", none.alias("_prefix"), none.alias("_at"), "_want"), rows
    for level in range(2 * LEVELS):
        if level == WIDE:
            left = staged(_with_state(rows, state).where(_digits(level)[1]).select(*rows.columns), "left")
        state = staged(_boundary(left, state, level), "boundary")
    shares = shares.join(state.select(F.col("source").alias("_s"), "_prefix", "_at"),
                         F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "_want", "weight")
    return rows, staged(shares, "shares")


def copies(number: Column, at: Column) -> Column:
    """How often a row with these numbers is taken, next to its source's plan."""
    again = (number < F.col("_prefix")) | ((number == F.col("_prefix")) & (at < F.col("_at")))
    return (F.col("_epochs") + F.when(again, 1).otherwise(0)).cast("int")


def mix(documents: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows, shares = plan(documents, **options)
    return (
        _with_state(rows, shares)
        .withColumn("copies", copies(F.col("_draw"), F.col("_place")))
        .select("doc_id", "source", "size", "source_size", "target", "copies",
                (F.col("size") * F.col("copies")).alias("taken"))
    )


def repeat(documents: DataFrame, seed: str = "mix-1", **options) -> DataFrame:
    """The mix itself: the documents, each as often as it is taken.

    Places are numbered again; where a table is read in another order, of rows equal in id
    and text as many are taken as their share of places gives.
    """
    if any(c.startswith("_sw_") for c in documents.columns):
        raise ValueError("Columns whose names begin with _sw_ cannot be carried")
    _, shares = plan(documents, seed=seed, **options)
    held = F.struct(*[col(c) for c in documents.columns]).alias("_sw_row")
    numbered = documents.select(
        held, F.col("source").alias("_source"), draw(F.col("doc_id"), F.col("text"), seed).alias("_draw"),
        place().alias("_place"))
    return (
        _with_state(numbered, shares)
        .select("_sw_row", F.explode(F.array_repeat(F.lit(0), copies(F.col("_draw"), F.col("_place")))).alias("_sw_copy"))
        .select(*[F.col("_sw_row").getField(c).alias(c) for c in documents.columns])
    )
