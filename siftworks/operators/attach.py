"""Joining rows to a one-row-per-key table when a key may be very hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.naming import col
from siftworks.staging import Staged

# A table may be broadcast whole up to both of these measured sizes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Files this small cannot hold many rows with different keys; no need to count.
TINY_BYTES = 1024 * 1024
# At most this many keys can each hold more than 1/HOT_KEYS of the rows.
HOT_KEYS = 50_000
SPREAD = 1024


def fits_broadcast(staged: Staged) -> bool:
    if staged.bytes <= TINY_BYTES:
        return True
    return staged.bytes <= BROADCAST_BYTES and staged.rows <= BROADCAST_ROWS


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    staged: Staged,
    keys: Sequence[str],
    *,
    weight: str = "_sw_n",
    spread: Sequence[str] = (),
    active: Column | None = None,
    hot_keys: int | None = None,
    broadcast_whole: bool | None = None,
) -> DataFrame:
    """Left-join ``lookup`` onto ``rows`` by null-safe equality of ``keys``.

    ``lookup`` is a projection of the staged table, one row per key, whose
    ``weight`` column says how many active rows carry the key; a key missing
    from it must be rare. Rows that are not ``active`` get nulls. No value column
    may have the name of a column of ``rows``.

    A table of checked size is broadcast, so the rows are not shuffled at all.
    Beyond that size the keys holding more than 1/hot_keys of all rows, fewer
    than ``hot_keys`` of them by counting, are broadcast, and only the rest is
    joined by shuffle. Rows already served and inactive rows are spread over
    that shuffle by ``spread``, so no task receives a hot key whole.
    """
    keys = list(keys)
    values = [c for c in lookup.columns if c not in keys]
    whole = fits_broadcast(staged) if broadcast_whole is None else broadcast_whole
    may_match = F.lit(True) if active is None else F.coalesce(active, F.lit(False))
    if whole:
        joined = _join(rows, F.broadcast(lookup), keys, values)
        if active is None:
            return joined
        return joined.withColumns({v: F.when(may_match, col(v)) for v in values})

    limit = hot_keys or HOT_KEYS
    total = lookup.agg(F.sum(col(weight))).first()[0] or 0
    cut = total / limit
    hot = lookup.where(col(weight) > cut)
    cold = lookup.where(col(weight) <= cut)
    renamed = {v: f"_hot_{v}" for v in values}
    served = _join(rows, F.broadcast(hot.withColumnsRenamed(renamed)), keys, list(renamed.values()))
    hit = col(f"_hot_{weight}").isNotNull()
    scatter = [col(c) for c in (spread or rows.columns)]
    served = served.withColumn(
        "_salt",
        F.when(hit | ~may_match, F.pmod(F.xxhash64(*scatter), F.lit(SPREAD)) + 1).otherwise(F.lit(0)),
    )
    joined = _join(served, cold.withColumn("_salt", F.lit(0).cast("bigint")), [*keys, "_salt"], values)
    return joined.select(
        *[col(c) for c in rows.columns],
        *[F.when(may_match, F.coalesce(col(f"_hot_{v}"), col(v))).alias(v) for v in values],
    )


def _join(rows: DataFrame, lookup: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    right = lookup.select(*[col(k).alias(f"_key_{k}") for k in keys], *[col(v) for v in values])
    match = None
    for key in keys:
        equal = col(key).eqNullSafe(col(f"_key_{key}"))
        match = equal if match is None else match & equal
    return rows.join(right, match, "left").drop(*[f"_key_{k}" for k in keys])
