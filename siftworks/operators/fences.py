"""Robust price fences from the first peer group that can carry them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.operators.attach import attach
from siftworks.operators.quantiles import exact_quantiles
from siftworks.staging import Staged, Staging

UNASSESSED = "unassessed"
# A peer group whose spread is no larger than this carries no fences.
MIN_SPREAD = 1e-12


@dataclass(frozen=True)
class PeerLevel:
    label: str
    columns: tuple[str, ...]


def group_keys(levels: Sequence[PeerLevel]) -> list[str]:
    """Key columns of the statistics: the level's label and as many values as the widest has."""
    return ["level", *[f"k{i}" for i in range(max(len(level.columns) for level in levels))]]


def peer_groups(levels: Sequence[PeerLevel]) -> Column:
    """Array of the groups a row belongs to, one struct of :func:`group_keys` per level."""
    names = group_keys(levels)[1:]

    def entry(level: PeerLevel) -> Column:
        named = [F.col(c).cast("string").alias(n) for c, n in zip(level.columns, names)]
        blank = [F.lit(None).cast("string").alias(n) for n in names[len(named):]]
        return F.struct(F.lit(level.label).alias("level"), *named, *blank)

    return F.array(*map(entry, levels))


def peer_statistics(
    rows: DataFrame, measure: str, levels: Sequence[PeerLevel], staging: Staging, **options
) -> Staged:
    """Size and quartiles of the log measure for every group of every level.

    Only rows with a positive measure have a logarithm and count as peers.
    """
    columns = sorted({c for level in levels for c in level.columns})
    # Written once and narrow, since the quantiles read their values a few times.
    narrow = staging.write(
        rows.where(F.col(measure) > 0).select(F.log(F.col(measure)).alias("_sw_x"), *columns), "logs"
    )
    logs = narrow.frame.select(
        F.col("_sw_x").alias("x"), F.explode(peer_groups(levels)).alias("g")
    ).select("g.*", "x")
    statistics = log_quartiles(logs, levels, staging, **options)
    narrow.drop()
    return statistics


def log_quartiles(logs: DataFrame, levels: Sequence[PeerLevel], staging: Staging, **options) -> Staged:
    """Size ``n`` and quartiles ``q`` of ``x`` for every group named by its keys."""
    return exact_quantiles(logs, group_keys(levels), "x", [0.25, 0.75], staging, **options)


def attach_fences(
    rows: DataFrame,
    statistics: Staged,
    measure: str,
    levels: Sequence[PeerLevel],
    *,
    min_peers: int,
    multiplier: float,
    spread: Sequence[str] = (),
    active: Column | None = None,
    **options,
) -> DataFrame:
    """Add the chosen level, peer count and both fences, falling back level by level.

    Rows that are not ``active`` get no evidence; active rows without a positive
    measure are unassessed.
    """
    positive = F.coalesce(F.col(measure) > 0, F.lit(False))
    peer = positive if active is None else active & positive
    spread_of = F.col("q")[1] - F.col("q")[0]
    usable = (F.col("n") >= min_peers) & (spread_of > MIN_SPREAD)
    result, evidence = rows, []
    for position, level in enumerate(levels):
        names = [f"_peer{position}_{i}" for i in range(len(level.columns))]
        name = f"_fence{position}"
        # Groups that cannot carry fences stay in, so that large ones are known to be hot.
        lookup = statistics.frame.where(F.col("level") == level.label).select(
            *[F.col(f"k{i}").alias(n) for i, n in enumerate(names)],
            F.col("n").alias("_peers"),
            F.when(usable, F.struct(
                F.lit(level.label).alias("level"),
                F.col("n").alias("n"),
                F.exp(F.col("q")[0] - multiplier * spread_of).alias("lower"),
                F.exp(F.col("q")[1] + multiplier * spread_of).alias("upper"),
            )).alias(name),
        )
        keyed = result.withColumns(
            {n: F.col(c).cast("string") for n, c in zip(names, level.columns)}
        )
        result = attach(
            keyed, lookup, statistics, names, weight="_peers", spread=spread, active=peer,
            **options,
        ).drop("_peers", *names)
        evidence.append(name)
    chosen = F.coalesce(*[F.col(name) for name in evidence])
    level, count = F.lit(UNASSESSED), F.lit(0).cast("bigint")
    if active is not None:
        level, count = F.when(active, level), F.when(active, count)
    return result.withColumns({
        "_anomaly_peer_level": F.coalesce(chosen["level"], level),
        "_anomaly_peer_count": F.coalesce(chosen["n"], count),
        "_anomaly_lower_ppsqm": chosen["lower"],
        "_anomaly_upper_ppsqm": chosen["upper"],
    }).drop(*evidence)


def outside_fences(measure: Column) -> Column:
    """True strictly outside the fences; false where there are none."""
    outside = (measure < F.col("_anomaly_lower_ppsqm")) | (measure > F.col("_anomaly_upper_ppsqm"))
    return F.coalesce(outside, F.lit(False))
