"""Hot keys, hot groups and physical layout must not change a result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.operators import attach as joining
from siftworks.operators.dedup import duplicate_index, mark_duplicates, winners
from siftworks.operators.fences import PeerLevel, attach_fences, peer_statistics
from siftworks.operators.quantiles import exact_quantiles
from siftworks.operators.reference import build_reference
from siftworks.plans import publish, stages
from siftworks.presets import property_sales as sales


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key; one key is null; the rest are spread."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
    )
    return spark.range(0, 6000, 1, 6).select("id", key.alias("k"), (F.col("id") % 11).alias("p"))


def test_attach_gives_the_same_rows_whole_hot_and_cold(skewed, staging):
    counted = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    table = staging.write(counted.where(~F.col("k").eqNullSafe(F.lit("k1"))), "counts")

    def rows(**options):
        joined = joining.attach(skewed, table.frame, table, ["k"], weight="n", spread=["id"], **options)
        return sorted(tuple(r) for r in joined.select("id", "k", "p", "n", "s").collect())

    whole = rows(broadcast_whole=True)
    assert len(whole) == 6000
    assert whole == rows(broadcast_whole=False, hot_keys=4)
    assert whole == rows(broadcast_whole=False, hot_keys=1_000_000)
    assert whole == rows(broadcast_whole=False, hot_keys=1)


def test_hot_rows_are_spread_and_only_hot_keys_broadcast(spark, skewed, staging):
    table = staging.write(skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "counts")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joining.attach(
            skewed, table.frame, table, ["k"], weight="n", spread=["id"], broadcast_whole=False,
            hot_keys=4,
        )
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        plan_text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan_text and "SortMergeJoin" in plan_text
    # The hot key has 2000 rows; the largest task gets less than that with all else.
    assert sum(t["count"] for t in tasks) == 6000 and max(t["count"] for t in tasks) < 1800


def test_quantiles_are_exact_and_equal_by_every_path(spark, staging):
    random = np.random.default_rng(5)
    groups = {
        "wide": random.normal(0, 1e6, 4000), "ties": random.integers(0, 4, 3000).astype(float),
        "log": np.exp(random.normal(0, 30, 2000)), "one": np.array([3.5]),
        "two": np.array([1.0, 2.0]), "same": np.full(500, -7.25),
        "close": 1.0 + random.integers(0, 1000, 3000) * 2.0**-50, "zero": np.array([0.0, -0.0] * 5),
        "mixed": np.array([-1.0, 0.0, -0.0, 1.0, 1e300, -1e300, 1e-300]),
    }
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    rows = spark.createDataFrame(data, "g string, v double").repartition(5)
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]

    def quantiles(**options):
        table = exact_quantiles(rows, ["g"], "v", shares, staging, **options)
        return {r.g: (r.n, r.q) for r in table.frame.collect()}

    found = quantiles(small_group_rows=10**9)
    # Bit for bit: a decision must not depend on the size of another group.
    assert str(dict(sorted(found.items()))) == str(dict(sorted(quantiles(small_group_rows=0).items())))
    assert found == quantiles(small_group_rows=0, bracket_rows=5)
    assert set(found) == set(groups)
    for group, values in groups.items():
        assert found[group][0] == len(values)
        assert found[group][1] == pytest.approx(np.quantile(values, shares), rel=1e-12, abs=1e-300)


def test_rows_without_a_logarithm_are_no_peers(spark, staging):
    rows = spark.createDataFrame(
        [(i, "g", float(i % 9)) for i in range(90)] + [(90, "g", None), (91, "z", 0.0)],
        "id bigint, g string, v double",
    )
    levels = (PeerLevel("own", ("g",)),)
    statistics = peer_statistics(rows, "v", levels, staging)
    fenced = attach_fences(rows, statistics, "v", levels, min_peers=20, multiplier=3.0)
    found = {
        (r.v is not None and r.v > 0, r._anomaly_peer_level, r._anomaly_peer_count)
        for r in fenced.collect()
    }
    assert found == {(True, "own", 80), (False, "unassessed", 0)}


def test_inactive_rows_match_nothing_and_are_spread(skewed, staging):
    table = staging.write(skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "counts")
    live = F.col("id") % 2 == 0
    for whole in (True, False):
        joined = joining.attach(
            skewed, table.frame, table, ["k"], weight="n", spread=["id"], active=live,
            broadcast_whole=whole, hot_keys=4,
        )
        assert joined.where(~live & F.col("n").isNotNull()).count() == 0
        assert joined.where(live & F.col("n").isNull()).count() == 0


def test_fences_agree_when_groups_are_joined_by_shuffle(spark, staging):
    """A flat group with a third of the rows, and inactive rows, on both join paths."""
    rows = spark.range(0, 900, 1, 5).select(
        "id",
        F.when(F.col("id") % 3 == 0, "flat").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.lit("all").alias("a"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(1.0 + F.col("id") % 17).alias("v"),
    )
    levels = (PeerLevel("own", ("g", "a")), PeerLevel("any", ("a",)))
    live = F.col("id") % 4 != 1
    statistics = peer_statistics(rows.where(live), "v", levels, staging)
    found = []
    for options in ({"broadcast_whole": True}, {"broadcast_whole": False, "hot_keys": 4}):
        fenced = attach_fences(
            rows, statistics, "v", levels, min_peers=20, multiplier=3.0, spread=["id"],
            active=live, **options,
        )
        found.append(sorted(map(str, fenced.collect())))
        by_level = {
            r[0]: r[1] for r in fenced.groupBy("_anomaly_peer_level").count().collect()
        }
        assert by_level[None] == rows.where(~live).count()
        assert by_level["any"] == rows.where(live & (F.col("g") == "flat")).count()
    assert found[0] == found[1]


@pytest.mark.parametrize("options", [{}, {"broadcast_whole": False, "hot_keys": 3}])
def test_a_hot_key_has_one_winner(spark, staging, options):
    rows = spark.range(0, 3000, 1, 7).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("h"),
        (F.col("id") % 100).alias("price"),
    ).orderBy(F.rand(3))
    index = duplicate_index(rows, "h", F.col("h"), [-F.col("price"), F.col("id")], "id", staging)
    marked = mark_duplicates(rows, index, "h", "id", **options)
    losers = marked.where(F.col("_reference_source_record_id").isNotNull())
    assert losers.count() == 999
    assert [r[0] for r in losers.select("_reference_source_record_id").distinct().collect()] == [99]
    best = winners(rows, ["h"], [-F.col("price"), F.col("id")], ["id"])
    assert best.where("h = 'hot'").select("id", "n").first() == (99, 1000)


def test_domains_too_large_for_literals_are_joined(frame, staging):
    config = JobConfig()
    rows = frame({}, {"town": "ELSEWHERE"}, {"town": None})
    known = build_reference(frame(), config, sales.CATEGORIES, staging, literal_values=0)
    assert known.literals == {}
    marked = known.mark_known(rows, ["town"], lambda c: f"_known_{c}")
    flags = {r._source_row: r._known_town for r in marked.collect()}
    assert flags == {1: True, 2: False, 3: False}


def test_domains_of_any_size_are_published(spark, frame, staging, tmp_path):
    config = JobConfig()
    base = frame().drop("town")
    rows = spark.range(6000).select(F.concat(F.lit("T"), "id").alias("town")).crossJoin(base)
    known = build_reference(rows, config, sales.CATEGORIES, staging)
    publish.write_report(known.frame, str(tmp_path), "values", "column", "value")
    written = spark.read.option("header", True).csv(f"{tmp_path}/reports/values")
    assert written.where("column = 'town'").select("value").distinct().count() == 6000
    told = known.report(config, "reports/values")
    assert told["domains"]["town"] == {"size": 6000, "values_in": "reports/values"}
    assert told["domains"]["flat_type"] == {"size": 1, "values_in": "reports/values"}


@pytest.mark.parametrize("layout", [1, 7, 64])
def test_layout_does_not_change_decisions(frame, staging, layout):
    changes = [
        {
            "block": str(i % 45), "resale_price": str(200000 + (i * 7919) % 50000),
            "town": "UNKNOWN" if i % 17 == 0 else "ALDER GROVE",
        }
        for i in range(120)
    ] + [{"block": "999", "resale_price": "9000000"}]
    best, invalid = {}, set()
    for row, change in enumerate(changes, 1):
        if change.get("town") == "UNKNOWN":
            invalid.add(row)
        else:
            rank = (-int(change["resale_price"]), row)
            best[change["block"]] = min(best.get(change["block"], rank), rank)
    kept = {block: row for block, (_, row) in best.items()}
    outlier = kept.pop("999")
    expected = {
        row: "validation" if row in invalid else "anomaly" if row == outlier
        else None if row == kept.get(change["block"]) else "duplicate"
        for row, change in enumerate(changes, 1)
    }
    rows = frame(*changes).orderBy(F.rand(layout)).repartition(layout)
    # Learning from these rows would make UNKNOWN known, so the domains come from the base row.
    known = build_reference(frame(), JobConfig(), sales.CATEGORIES, staging)
    accepted, rejected = stages.validate(rows, known, JobConfig(), staging)
    unique, duplicates = stages.deduplicate(accepted, staging)
    clean, outliers = stages.detect_anomalies(unique, JobConfig(), staging)
    found = {}
    for stage, part in (("validation", rejected), ("duplicate", duplicates), (None, clean), ("anomaly", outliers)):
        found |= dict.fromkeys((r[0] for r in part.select("_source_row").collect()), stage)
    assert found == expected
    references = {(r.block, r._reference_source_record_id) for r in duplicates.collect()}
    assert references <= {(block, f"row-{row}") for block, row in kept.items()}


def test_stage_functions_agree_with_the_plan(judge, staging):
    changes = [{"block": str(i % 30), "resale_price": str(200000 + i)} for i in range(60)]
    valid, rejected = judge(*changes, {"town": "UNKNOWN"})
    unique, duplicates = stages.deduplicate(valid, staging)
    assert (rejected.count(), unique.count(), duplicates.count()) == (1, 30, 30)
