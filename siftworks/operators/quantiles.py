"""Exact group quantiles that never hold an unbounded group in one task.

Group sizes are counted first. When every group is small, its values are sorted
in one buffer, bounded by the checked size. Otherwise the wanted ranks are found
by counting. Both ways end in the same values at the same ranks and in the same
interpolation, so a quantile never depends on the way taken. When counting, every pass is an aggregate with a
map-side combine. The first one counts each group's values in buckets whose
edges depend on the value alone and are about 1.6 % apart, so a group has a
bounded number of buckets whatever its size. Counting up the buckets tells
which of them hold the wanted ranks. Only the values in those few buckets are
looked at again: narrowed by equal steps while a bucket still holds many rows,
then counted value by value. Equal values collapse in the counts, so a single
repeated value costs one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.operators.attach import attach
from siftworks.staging import Staged, Staging

LOG_STEPS = 64
LINEAR_STEPS = 4096
# Rows a group may have for its values to be held in one aggregation buffer.
SMALL_GROUP_ROWS = 50_000
# Rows one bracket may hold when its distinct values are finally listed.
BRACKET_ROWS = 1_000_000

_X = "_x"


def exact_quantiles(
    values: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    staging: Staging,
    *,
    small_group_rows: int | None = None,
    bracket_rows: int | None = None,
) -> Staged:
    """Staged table of ``keys``, ``n`` and ``q``, the linearly interpolated quantiles.

    ``value`` must be a finite double. ``values`` is read a few times, so it
    should be cheap to read.
    """
    keys = list(keys)
    small = SMALL_GROUP_ROWS if small_group_rows is None else small_group_rows
    limit = bracket_rows or BRACKET_ROWS
    # Adding zero leaves one zero: -0.0 and 0.0 are one value to a grouping.
    rows = values.where(F.col(value).isNotNull()).select(
        *keys, (F.col(value).cast("double") + F.lit(0.0)).alias(_X)
    )
    sizes = rows.groupBy(*keys).agg(F.count(_X).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= small:
        return staging.write(_buffered(rows, keys, probabilities), "quantiles")
    brackets = staging.write(
        _first_brackets(rows, keys, probabilities), "brackets", widest=_widest()
    )
    while (brackets.metrics["widest"] or 0) > limit:
        brackets = staging.write(_narrow(rows, keys, brackets), "brackets", widest=_widest())
    return staging.write(_settle(rows, keys, brackets, probabilities), "quantiles")


def _buffered(rows: DataFrame, keys: list[str], probabilities: Sequence[float]) -> DataFrame:
    groups = rows.groupBy(*keys).agg(
        F.count(_X).alias("n"), F.sort_array(F.collect_list(_X)).alias("at")
    )
    return groups.select(*keys, "n", _interpolated(probabilities, "int"))


def _interpolated(probabilities: Sequence[float], rank: str) -> Column:
    """The quantiles ``q`` of a group of ``n`` values, from ``at``: its values by rank."""
    def quantile(probability: float) -> Column:
        position = (F.col("n") - 1) * F.lit(float(probability))
        low_rank = F.floor(position).cast(rank)
        high_rank = F.least(low_rank + 1, (F.col("n") - 1).cast(rank))
        low, high = F.col("at")[low_rank], F.col("at")[high_rank]
        return low + (high - low) * (position - low_rank)

    return F.array(*[quantile(p) for p in probabilities]).alias("q")


def _log_bucket(x: Column) -> Column:
    """A bucket number that never decreases as the value grows."""
    step = F.floor(F.log(F.abs(x)) * LOG_STEPS).cast("bigint")
    # |ln| of a finite double stays below 746, so the signs cannot overlap.
    shifted = step + F.lit(746 * LOG_STEPS)
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x > 0, shifted).otherwise(-shifted)


def _ranks(n: Column, probabilities: Sequence[float]) -> Column:
    """Zero-based ranks needed to interpolate at the probabilities."""
    low = [F.floor((n - 1) * F.lit(float(p))).cast("bigint") for p in probabilities]
    return F.array_distinct(F.array(*low, *[F.least(r + 1, n - 1) for r in low]))


def _counted(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(
        F.count(_X).alias("c"), F.min(_X).alias("lo"), F.max(_X).alias("hi")
    )


def _holding(frame: DataFrame, ranks: Column) -> DataFrame:
    """Keep the buckets [start, start + c) that hold at least one wanted rank."""
    return frame.where(
        F.exists(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("c")))
    )


def _collected(frame: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: its size, its wanted ranks and at most one bracket per rank."""
    bracket = F.struct("start", "c", "lo", "hi")
    return frame.groupBy(*keys, "n", "ranks").agg(F.collect_list(bracket).alias("brackets"))


def _first_brackets(rows: DataFrame, keys: list[str], probabilities: Sequence[float]) -> DataFrame:
    counted = _counted(rows.withColumn("bucket", _log_bucket(F.col(_X))), [*keys, "bucket"])
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        counted.withColumn("n", F.sum("c").over(group))
        .withColumn("start", F.sum("c").over(upto) - F.col("c"))
        .withColumn("ranks", _ranks(F.col("n"), probabilities))
    )
    return _collected(_holding(placed, F.col("ranks")), keys)


def _widest() -> Column:
    """Rows in the fullest bracket that still holds more than one value."""
    open_rows = F.transform("brackets", lambda b: F.when(b.lo < b.hi, b.c).otherwise(F.lit(0)))
    return F.max(F.array_max(open_rows))


def _candidates(rows: DataFrame, keys: list[str], brackets: Staged) -> DataFrame:
    """The rows inside an open bracket, each with that bracket as ``b``."""
    looked_up = attach(rows, brackets.frame, brackets, keys, weight="n", spread=[_X])
    x = F.col(_X)
    inside = F.filter("brackets", lambda b: (b.lo < b.hi) & (x >= b.lo) & (x <= b.hi))
    return looked_up.withColumn("b", F.get(inside, 0)).where(F.col("b").isNotNull())


def _narrow(rows: DataFrame, keys: list[str], brackets: Staged) -> DataFrame:
    lo, hi = F.col("b.lo"), F.col("b.hi")
    step = F.floor((F.col(_X) - lo) / (hi - lo) * LINEAR_STEPS).cast("bigint")
    stepped = (
        _candidates(rows, keys, brackets)
        .withColumn("base", F.col("b.start"))
        .withColumn("step", F.least(step, F.lit(LINEAR_STEPS).cast("bigint")))
    )
    group = [*keys, "n", "ranks", "base"]
    counted = _counted(stepped, [*group, "step"])
    upto = Window.partitionBy(*group).orderBy("step").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = counted.withColumn("start", F.col("base") + F.sum("c").over(upto) - F.col("c"))
    kept = _holding(placed, F.col("ranks")).select(*keys, "n", "ranks", "start", "c", "lo", "hi")
    return _collected(kept.unionByName(_closed(keys, brackets)), keys)


def _closed(keys: list[str], brackets: Staged) -> DataFrame:
    """Brackets that hold one value only and need no further look."""
    return (
        brackets.frame.select(*keys, "n", "ranks", F.explode("brackets").alias("b"))
        .where(F.col("b.lo") == F.col("b.hi"))
        .select(*keys, "n", "ranks", "b.*")
    )


def _settle(
    rows: DataFrame, keys: list[str], brackets: Staged, probabilities: Sequence[float]
) -> DataFrame:
    group = [*keys, "n", "ranks", "base"]
    listed = (
        _candidates(rows, keys, brackets)
        .withColumn("base", F.col("b.start"))
        .groupBy(*group, _X)
        .agg(F.count(F.lit(1)).alias("c"))
    )
    upto = Window.partitionBy(*group).orderBy(_X).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = listed.select(
        *keys, "n", "ranks", "c", F.col(_X).alias("x"),
        (F.col("base") + F.sum("c").over(upto) - F.col("c")).alias("start"),
    )
    closed = _closed(keys, brackets).withColumn("x", F.col("lo"))
    values = ["n", "ranks", "c", "x", "start"]
    rank = F.col("rank")
    ranked = (
        placed.unionByName(closed.select(*keys, *values))
        .select("*", F.explode("ranks").alias("rank"))
        .where((rank >= F.col("start")) & (rank < F.col("start") + F.col("c")))
    )
    at_rank = F.map_from_entries(F.collect_list(F.struct("rank", "x")))
    groups = ranked.groupBy(*keys, "n").agg(at_rank.alias("at"))
    return groups.select(*keys, "n", _interpolated(probabilities, "bigint"))
