"""Refreshing published decisions after some source rows came, went or changed.

A snapshot keeps every decided row in a partition by month, with the peer statistics and the
reference domains beside them. A refresh follows a change to all that depends on it:

* changed rows -> their composite keys: only rows of these keys, which all lie in the months
  of the change, are ranked again;
* winners that came or went -> their peer groups, of all months: only these groups'
  statistics are computed again;
* groups whose statistics are different now -> the rows whose evidence changes with them,
  wherever they lie;
* the months of all these rows -> their group means, identifiers and digests, which never
  reach beyond a month.

Only these months are written anew; a snapshot is a numbered document that names the folder of
each month, so the others stay the files they were, and readers of an earlier snapshot are not
disturbed. A change of the reference month that changes a domain concerns every row and is
decided by a full build from the rows at hand.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.functions.identity import packed, unpacked
from siftworks.functions.periods import is_month
from siftworks.functions.text import strip
from siftworks.operators.attach import attach
from siftworks.operators.fences import attach_fences, group_keys, log_quartiles, peer_groups
from siftworks.operators.reference import Reference, category_values, read_reference
from siftworks.plans import decide as plan
from siftworks.presets import property_sales as sales
from siftworks.sources import files
from siftworks.staging import DENSE, Staged, Staging, spent_shuffles, write_observed

PARTITION = "_sw_month"
MALFORMED = "malformed"
MEASURE = "price_per_sqm"
WIDENED = (
    ("group_average_resale_price", "double"), ("Resale Identifier", "string"),
    ("resale_identifier_hash", "string"), ("resale_record_hash", "string"),
)
_EVIDENCE = list(sales.EVIDENCE)
#: Hex digests, each row's own, that are shuffled in their binary form.
_DIGESTS = [
    plan.ROW_ID, "_key_hash", "_reference_source_record_id", "resale_identifier_hash", "resale_record_hash",
]


def partition_of(month: Column) -> Column:
    """The month a row is kept under; all malformed ones share a partition."""
    tidy = strip(month)
    return F.when(is_month(tidy), tidy).otherwise(MALFORMED)


@dataclass(frozen=True)
class Snapshot:
    """One published state: where each month, the statistics and the reference lie."""

    spark: SparkSession
    root: str
    number: int
    months: dict[str, str]
    statistics: str
    reference: str
    columns: list[str]
    config: JobConfig
    rewritten: list[str]

    def rows(self, months: Iterable[str] | None = None) -> DataFrame:
        """Decided rows of the given months, or of all; folders of other months are not read."""
        chosen = self.months if months is None else {m: self.months[m] for m in months if m in self.months}
        if not chosen:
            return self.rows().where("false") if self.months else _nothing(self)
        by_folder: dict[str, list[str]] = {}
        for month, folder in chosen.items():
            by_folder.setdefault(folder, []).append(month)
        schema = self.spark.read.parquet(f"{self.root}/schema").schema
        parts = [
            self.spark.read.schema(schema).option("basePath", folder).parquet(
                *[f"{folder}/{PARTITION}={m}" for m in sorted(listed)])
            for folder, listed in sorted(by_folder.items())
        ]
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    def statistics_table(self) -> Staged:
        return _written(self.spark, self.statistics)

    def reference_table(self, staging: Staging) -> Reference:
        return read_reference(
            _written(self.spark, self.reference), self.config, sales.CATEGORIES, staging, bands=sales.BANDS)


def _nothing(snapshot: Snapshot) -> DataFrame:
    return snapshot.spark.read.parquet(f"{snapshot.root}/schema")


def _written(spark: SparkSession, path: str) -> Staged:
    return Staged(spark, path, spark.read.parquet(path).schema, {})


def _log(root: str) -> str:
    return f"{root}/snapshots"


def newest(spark: SparkSession, root: str) -> Snapshot:
    """The newest whole snapshot under ``root``."""
    found = files.newest_in_log(spark, _log(root))
    if found is None:
        raise FileNotFoundError(f"No snapshot in {root}")
    number, described = found
    config = JobConfig(**described.pop("config"))
    return Snapshot(spark, root, number, config=config, **described)


def _publish(
    spark: SparkSession, root: str, after: int, months: dict[str, str], statistics: str, reference: str,
    columns: list[str], config: JobConfig, rewritten: list[str],
) -> Snapshot:
    described = {
        "months": months, "statistics": statistics, "reference": reference, "columns": columns,
        "config": config.as_dict(), "rewritten": rewritten,
    }
    files.append_to_log(spark, _log(root), described, after=after)
    return newest(spark, root)


def _widened(decided: DataFrame, staging: Staging) -> DataFrame:
    """Decided rows with group mean, identifier and digests where they are cleaned."""
    cleaned = F.col("_quarantine_stage").isNull()
    coded = plan.transform(decided.where(cleaned), staging)
    rest = decided.where(~cleaned).withColumns({n: F.lit(None).cast(t) for n, t in WIDENED})
    return coded.unionByName(rest).withColumn(PARTITION, partition_of(F.col("_recorded_month")))


def _write_months(rows: DataFrame, folder: str) -> list[str]:
    """Write partitions and name them; months are few, whatever the rows."""
    spread = rows.withColumns({c: packed(F.col(c)) for c in _DIGESTS}).hint("rebalance", PARTITION)
    whole = spread.withColumns({c: unpacked(F.col(c)) for c in _DIGESTS})
    whole.write.partitionBy(PARTITION).option("compression", DENSE).parquet(folder)
    written = files.folders(rows.sparkSession, folder)
    return sorted(name.removeprefix(f"{PARTITION}=") for name in written if name.startswith(f"{PARTITION}="))


def build(
    spark: SparkSession, rows: DataFrame, config: JobConfig, root: str, *, after: int = 0,
) -> Snapshot:
    """Decide all rows and publish them as a snapshot."""
    with spent_shuffles(spark):
        return _build(spark, rows, config, root, after)


def _build(spark: SparkSession, rows: DataFrame, config: JobConfig, root: str, after: int) -> Snapshot:
    staging = Staging(spark)
    fresh = f"{root}/{uuid.uuid4().hex}"
    try:
        master = plan.write_master(rows, f"{staging.root}/master")
        decided = plan.decide(master, config, staging, drop_master=True)
        decisions = decided.staged(staging, "decisions").frame
        wide = _widened(decisions, staging)
        if not files.exists(spark, f"{root}/schema"):
            wide.where("false").write.parquet(f"{root}/schema")
        months = _write_months(wide, f"{fresh}/rows")
        decided.statistics.frame.write.parquet(f"{fresh}/statistics")
        decided.reference.table.frame.write.parquet(f"{fresh}/reference")
        return _publish(
            spark, root, after, dict.fromkeys(months, f"{fresh}/rows"), f"{fresh}/statistics",
            f"{fresh}/reference", sales.source_columns(rows), config, months)
    finally:
        staging.drop()


def _originals(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Master rows, as they were read, from decided ones."""
    return rows.select(*[F.col("_raw").getField(c).alias(c) for c in columns], *sales.LINEAGE)


def _months_of(frame: DataFrame) -> set[str]:
    return {r[0] for r in frame.select(partition_of(F.col("month"))).distinct().collect()}


def _undecided(rows: DataFrame) -> DataFrame:
    """Assessed rows as they were before duplicates and fences, with validation kept."""
    invalid = F.col("_quarantine_stage") == "validation"
    return rows.withColumns({
        "_quarantine_stage": F.when(invalid, F.col("_quarantine_stage")),
        "_quarantine_reasons": F.when(invalid, F.col("_quarantine_reasons")).otherwise(
            F.array().cast("array<string>")),
    }).drop("_reference_source_record_id", *_EVIDENCE, *[n for n, _ in WIDENED], PARTITION)


def _unfenced(rows: DataFrame) -> DataFrame:
    """Decided rows as they were before the fences, with validation and duplicates kept."""
    flagged = F.coalesce(F.col("_quarantine_stage") == "anomaly", F.lit(False))
    return rows.withColumns({
        "_quarantine_stage": F.when(~flagged, F.col("_quarantine_stage")),
        "_quarantine_reasons": F.when(flagged, F.array().cast("array<string>")).otherwise(
            F.col("_quarantine_reasons")),
    }).drop(*_EVIDENCE, *[n for n, _ in WIDENED], PARTITION)


def _won() -> Column:
    """Rows that are valid and the best of their key, flagged by the fences or not."""
    return F.col("_quarantine_stage").isNull() | (F.col("_quarantine_stage") == "anomaly")


def _affected_keys(
    kept: DataFrame, gone: DataFrame, added: DataFrame, staging: Staging
) -> Staged:
    """Keys of rows that came or went, and how many of the rows that stay have them."""
    def part(rows: DataFrame, changed: bool) -> DataFrame:
        return rows.where(F.col("_key_hash").isNotNull()).select(
            "_key_hash", F.lit(changed).alias("changed"))

    counted = part(kept, False).unionByName(part(gone, True)).unionByName(part(added, True))
    keys = counted.groupBy("_key_hash").agg(
        F.count(F.lit(1)).alias("_sw_n"), F.max("changed").alias("_hit"))
    return staging.write(keys.where("_hit"), "keys")


def _touched_groups(before: DataFrame, after: DataFrame, old: DataFrame, staging: Staging) -> Staged:
    """Peer groups whose winners are not the same before and after, with a bound of their size."""
    keys = group_keys(sales.PEER_LEVELS)

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        peers = rows.where(_won() & (F.col(MEASURE) > 0))
        return peers.select(
            F.explode(peer_groups(sales.PEER_LEVELS)).alias("g"), F.lit(sign).alias("sign"),
            (F.xxhash64(MEASURE).cast("decimal(20,0)") * sign).alias("mark"),
        ).select("g.*", "sign", "mark")

    moved = signed(before, -1).unionByName(signed(after, 1)).groupBy(*keys).agg(
        F.sum("sign").alias("more"), F.sum("mark").alias("mark"), F.count_if(F.col("sign") > 0).alias("came"))
    moved = moved.where((F.col("more") != 0) | (F.col("mark") != 0)).select(
        *[F.col(k).alias(f"_{k}") for k in keys], "came")
    match = _same(keys)
    sized = moved.join(old.select(*keys, "n"), match, "left")
    return staging.write(sized.select(
        *[F.col(f"_{k}").alias(k) for k in keys],
        (F.coalesce("n", F.lit(0)) + F.col("came")).alias("_sw_n"), F.lit(True).alias("_hit")), "touched")


def _same(keys: list[str]) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return match


def _new_statistics(
    old: DataFrame, winners: DataFrame, touched: Staged, path: str, staging: Staging
) -> tuple[Staged, Staged]:
    """All statistics with the touched groups computed anew, and the groups that differ now."""
    keys = group_keys(sales.PEER_LEVELS)
    logs = winners.where(_won() & (F.col(MEASURE) > 0)).select(
        F.explode(peer_groups(sales.PEER_LEVELS)).alias("g"), F.log(MEASURE).alias("x")
    ).select("g.*", "x")
    inside = attach(logs, touched.frame, touched, keys, spread=["x"]).where("_hit").select(*keys, "x")
    logs = staging.write_wide(inside, "logs")
    again = log_quartiles(logs.frame, sales.PEER_LEVELS, staging)
    logs.drop()
    renamed = touched.frame.select(*[F.col(k).alias(f"_{k}") for k in keys], "_hit")
    marked = old.join(renamed, _same(keys), "left").drop(*[f"_{k}" for k in keys])
    untouched = marked.where("_hit IS NULL").select(*old.columns)
    whole = write_observed(untouched.unionByName(again.frame.select(*old.columns)), path)
    was = marked.where("_hit").select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct("n", "q").alias("was"))
    now = again.frame.select(*keys, F.struct("n", "q").alias("now"), F.col("n").alias("_sw_n"))
    both = now.join(was, _same(keys), "left").where(~F.col("now").eqNullSafe(F.col("was")))
    return whole, staging.write(both.select(*keys, "_sw_n", F.lit(True).alias("_hit")), "different")


def _in_groups(rows: DataFrame, groups: Staged) -> DataFrame:
    """The rows that belong to any of the groups."""
    flags = []
    for i, level in enumerate(sales.PEER_LEVELS):
        names = [f"_g{i}_{j}" for j in range(len(level.columns))]
        lookup = groups.frame.where(F.col("level") == level.label).select(
            *[F.col(f"k{j}").alias(n) for j, n in enumerate(names)],
            F.col("_sw_n").alias(f"_n{i}"), F.col("_hit").alias(f"_hit{i}"))
        keyed = rows.withColumns({n: F.col(c).cast("string") for n, c in zip(names, level.columns)})
        rows = attach(keyed, lookup, groups, names, weight=f"_n{i}", spread=[plan.ROW_ID]).drop(f"_n{i}", *names)
        flags.append(f"_hit{i}")
    return rows.where(F.coalesce(*map(F.col, flags), F.lit(False))).drop(*flags)


def _months_with_new_evidence(
    rows: DataFrame, different: Staged, statistics: Staged, config: JobConfig
) -> set[str]:
    """Months of rows, read narrow, whose evidence is not what it was."""
    columns = sorted({c for level in sales.PEER_LEVELS for c in level.columns})
    narrow = rows.where(_won()).select(
        PARTITION, plan.ROW_ID, MEASURE, *columns, F.struct(*_EVIDENCE).alias("was"))
    fenced = attach_fences(
        _in_groups(narrow, different), statistics, MEASURE, sales.PEER_LEVELS,
        min_peers=config.anomaly_min_peers, multiplier=config.anomaly_iqr_multiplier, spread=[plan.ROW_ID])
    changed = fenced.where(~F.struct(*_EVIDENCE).eqNullSafe(F.col("was")))
    return {r[0] for r in changed.select(PARTITION).distinct().collect()}


def _without(rows: DataFrame, removed: DataFrame) -> DataFrame:
    return rows.join(removed.select(plan.ROW_ID), plan.ROW_ID, "left_anti")


def _new_reference(
    snapshot: Snapshot, touched: set[str], kept: DataFrame, added: plan.Master, path: str, staging: Staging
) -> tuple[str, bool]:
    """Where the reference lies now, and whether its domains are what they were."""
    month = snapshot.config.reference_month
    if month not in touched:
        return snapshot.reference, True
    in_month = strip(F.col("month")) == month
    old = _originals(kept.where(F.col(PARTITION) == month), snapshot.columns).where(in_month)
    columns = ["month", *sales.CATEGORIES]
    counted = category_values(
        old.select(*columns).unionByName(added.frame.where(in_month).select(*columns)), sales.CATEGORIES)
    write_observed(counted, path)
    before, now = (_written(snapshot.spark, p).frame.select("column", "value") for p in (snapshot.reference, path))
    differ = before.exceptAll(now).unionByName(now.exceptAll(before))
    return path, differ.isEmpty()


def refresh(
    spark: SparkSession, root: str, added: DataFrame, removed: DataFrame
) -> Snapshot:
    """Publish the snapshot that a full build over the changed rows would give.

    ``added`` has the columns of a master table; ``removed`` has the record id and the ``month``
    text of rows that go. A changed row is in both.
    """
    with spent_shuffles(spark):
        return _refresh(spark, root, added, removed)


def _refresh(spark: SparkSession, root: str, added: DataFrame, removed: DataFrame) -> Snapshot:
    snapshot = newest(spark, root)
    config, columns = snapshot.config, snapshot.columns
    if sales.source_columns(added) != columns:
        raise ValueError("Added rows must have the columns of the snapshot")
    staging = Staging(spark)
    fresh = f"{root}/{uuid.uuid4().hex}"
    try:
        removed = staging.write(removed.select(plan.ROW_ID, "month").distinct(), "removed").frame
        new = plan.write_master(added, f"{staging.root}/added")
        touched = _months_of(new.frame) | _months_of(removed)
        affected = snapshot.rows(touched)
        kept = _without(affected, removed)
        reference, same = _new_reference(snapshot, touched, kept, new, f"{fresh}/reference", staging)
        if not same:
            left = _originals(_without(snapshot.rows(), removed), columns)
            return build(spark, left.unionByName(new.frame.select(*left.columns)), config, root, after=snapshot.number)

        gone = affected.join(removed.select(plan.ROW_ID), plan.ROW_ID, "left_semi")
        known = read_reference(
            _written(spark, reference), config, sales.CATEGORIES, staging, bands=sales.BANDS)
        assessed = staging.write(
            sales.assess(
                plan.compose_text(new.frame, new.ascii_columns, staging), known, config,
                ascii_columns=new.ascii_columns), "assessed").frame
        keys = _affected_keys(kept, gone, assessed, staging)
        hit = attach(kept, keys.frame, keys, ["_key_hash"], spread=[plan.ROW_ID]).drop("_sw_n")
        kept = staging.write_wide(hit, "kept").frame
        again, still = kept.where("_hit").drop("_hit"), kept.where("_hit IS NULL").drop("_hit")
        ranked, _ = plan.with_duplicates(_undecided(again).unionByName(assessed), staging)
        ranked = staging.write_wide(ranked, "ranked").frame

        old = snapshot.statistics_table()
        groups = _touched_groups(
            gone.select("_quarantine_stage", MEASURE, *_peer_columns()).unionByName(
                again.select("_quarantine_stage", MEASURE, *_peer_columns())),
            ranked, old.frame, staging)
        others = snapshot.rows(set(snapshot.months) - touched)
        peers = ["_quarantine_stage", MEASURE, *_peer_columns()]
        winners = others.select(*peers).unionByName(still.select(*peers)).unionByName(ranked.select(*peers))
        statistics, different = _new_statistics(old.frame, winners, groups, f"{fresh}/statistics", staging)

        moved = _months_with_new_evidence(others, different, statistics, config)
        rows = _unfenced(snapshot.rows(moved)).unionByName(_unfenced(still)).unionByName(ranked)
        decided = staging.write_wide(plan.with_fences(rows, statistics, config), "decided").frame
        written = _write_months(_widened(decided, staging), f"{fresh}/rows")
        rewritten = touched | moved
        months = {m: f for m, f in snapshot.months.items() if m not in rewritten}
        return _publish(
            spark, root, snapshot.number, months | dict.fromkeys(written, f"{fresh}/rows"), statistics.path,
            reference, columns, config, sorted(rewritten))
    finally:
        staging.drop()


def _peer_columns() -> list[str]:
    return sorted({c for level in sales.PEER_LEVELS for c in level.columns})
