"""What a job leaves on disk while it runs: tables that were read for the last time, shuffles of ended executions."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftworks import staging as areas
from siftworks.catalog import evolution
from siftworks.config import JobConfig
from siftworks.functions.identity import packed, unpacked
from siftworks.operators import attach as joining
from siftworks.operators import dedup, profile
from siftworks.plans import decide as plan
from siftworks.plans import incremental, publish, verify
from siftworks.plans.job import key_hash, publish_run
from siftworks.staging import _CLEANUP, spent_shuffles

TEXTS = [
    "ab" * 32, "AB" * 32, "0" * 64, "0" * 63, "g" * 64, "x" * 31, "y" * 32, "", " ", "row-1", "\x00", "ü" * 32, None,
]


def tables(root) -> dict[str, Path]:
    """Staged tables by name, without what makes their folders unique."""
    found = [p for p in Path(root.removeprefix("file:")).glob("*") if p.is_dir()]
    return {p.name.rsplit("-", 1)[0]: p for p in found}


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """A folder for staged tables of its own."""
    monkeypatch.setattr(areas, "shared_folder", lambda spark: str(tmp_path / "shared"))
    return tmp_path / "shared"


@pytest.fixture
def shuffled_join(spark, monkeypatch):
    """Lookups count as too large to be broadcast, as they are on large tables."""
    monkeypatch.setattr(joining, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joining, "TINY_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffle_bytes(spark) -> int:
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(p.stat().st_size for d in folder for p in Path(d.getPath()).rglob("shuffle_*"))


def test_packed_texts_come_back_and_stay_apart(evaluate):
    assert evaluate(lambda v: unpacked(packed(v)), TEXTS) == TEXTS
    forms = evaluate(packed, TEXTS)
    assert len({bytes(f) for f in forms[:-1]}) == len(TEXTS) - 1 and forms[-1] is None
    assert [len(f) == 32 for f in forms[:-1]] == [True, False, True] + [False] * (len(TEXTS) - 4)


def test_shuffles_go_when_their_execution_ends(spark):
    rows = spark.range(0, 200_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    before = spark.conf.get(_CLEANUP)
    with spent_shuffles(spark):
        assert spark.conf.get(_CLEANUP) == "true"
        start = shuffle_bytes(spark)
        assert rows.groupBy("h").count().agg(F.max("count")).first()[0] == 1
        for _ in range(100):
            if shuffle_bytes(spark) <= start:
                break
            time.sleep(0.1)
        assert shuffle_bytes(spark) <= start
    assert spark.conf.get(_CLEANUP) == before


def test_the_job_keeps_one_copy_of_the_rows(spark, frame, staging, tmp_path):
    """assessed rows went with the decisions, coded ones are not written."""
    rows = frame({}, {"block": "8"}, {"block": "8", "resale_price": "2"}, {"month": "2012-02", "town": "UNKNOWN"})
    published = publish_run(spark, rows, JobConfig(), f"{tmp_path}/run", staging)
    left = tables(staging.root)
    assert "decisions" in left and not {"assessed", "marked", "coded", "logs", "repeated"} & set(left)
    assert published.counts["transformed_rows"] == 2 and published.counts["unique_record_hashes"] == 2


def test_contracts_are_checked_one_after_the_other(spark, frame, staging, tmp_path, monkeypatch):
    """no two checks share an execution, so their shuffles never lie side by side."""
    published = publish_run(spark, frame({}, {"block": "8"}), JobConfig(), f"{tmp_path}/run", staging)
    open_checks, order = [], []
    unpivot, constant = verify._unpivot, verify._constant

    def collected(frame):
        collect = frame.collect

        def run():
            order.append(len(open_checks))
            open_checks.clear()
            return collect()

        frame.collect = run
        open_checks.append(1)
        return frame

    monkeypatch.setattr(verify, "_unpivot", lambda *a: collected(unpivot(*a)))
    monkeypatch.setattr(verify, "_constant", lambda s, found: constant(s, found))
    checks = verify.contract_checks(
        spark, published.run, published.columns, published.reference, JobConfig(), key_hash(published.columns),
        [("extra", 3, 1)])
    assert order == [1] * 12
    found = {r.check: (r.passed, r.violations, r.rows_checked) for r in checks.collect()}
    assert len(found) == 23 and found.pop("extra") == (False, 1, 3)
    assert all(passed for passed, *_ in found.values()) and found["copies_agree:cleaned"] == (True, 0, 2)


def test_published_rows_are_in_order_with_their_digests(spark, frame, tmp_path):
    rows = frame(*[{"month": f"2012-{m:02d}"} for m in (3, 1, 2)]).repartition(3).withColumns({
        "_source_record_id": F.when(F.col("_source_row") == 2, F.sha2("month", 256)).otherwise(F.col("_source_record_id")),
        "_reference_source_record_id": F.lit(None).cast("string")})
    written = publish.write_parquet(rows, f"{tmp_path}/run", "quarantined")
    digest = rows.where("_source_row = 2").first()._source_record_id
    assert len(digest) == 64
    assert [(r.month, r._source_record_id) for r in written.coalesce(1).orderBy("month").collect()] == [
        ("2012-01", digest), ("2012-02", "row-3"), ("2012-03", "row-1")]
    assert written.where(F.col("_reference_source_record_id").isNotNull()).isEmpty()
    assert written.schema == rows.schema


def test_rows_of_single_keys_are_marked_without_a_shuffle(spark, staging, shuffled_join):
    """F1 to F5: only rows whose key may repeat are shuffled to the index; null keys and inactive rows stay."""
    key = F.when(F.col("id") % 50 < 2, F.concat(F.lit("k"), F.floor(F.col("id") / 50).cast("string"))).when(
        F.col("id") % 50 == 2, F.lit(None).cast("string")).otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
    rows = staging.write(spark.range(0, 5000, 1, 4).select(
        F.col("id").cast("string").alias("row"), "id", key.alias("h"), (F.col("id") % 7 != 3).alias("live")), "rows").frame
    live = F.col("live") & F.col("h").isNotNull()
    index = dedup.duplicate_index(rows.where(live), "h", F.col("h"), [F.col("id")], "row", staging)
    assert dedup.marks_fit(index)
    marked = dedup.mark_duplicates(rows, index, "h", "row", active=live)
    plain = dedup.mark_duplicates(rows, index, "h", "row", active=live, broadcast_whole=True)
    assert marked.columns == plain.columns
    assert sorted(map(str, marked.collect())) == sorted(map(str, plain.collect()))
    text = marked._jdf.queryExecution().sparkPlan().toString()
    assert text.count("LeftSemi, BuildRight") == 1 and text.count("LeftAnti, BuildRight") == 1


@pytest.mark.parametrize("few, left", [(0, {"marked"}), (8, {"assessed"})])
def test_decided_rows_replace_what_they_were_read_from(spark, frame, staging, shuffled_join, monkeypatch, few, left):
    """F3 to F5: at most one copy of the rows stands beside the one being written."""
    monkeypatch.setattr(plan, "FEW_COPIES", few or 10**9)
    rows = frame({}, *[{"block": str(i)} for i in range(20)], {"block": "7", "resale_price": "2"})
    master = plan.write_master(rows, f"{staging.root}/master")
    decided = plan.decide(master, JobConfig(), staging, drop_master=True)
    wide = {"master", "assessed", "marked", "decided"}
    assert wide & set(tables(staging.root)) == left
    written = decided.staged(staging, "decided")
    assert wide & set(tables(staging.root)) == {"decided"}
    assert written.frame.count() == 22 and written.frame.where("_quarantine_stage = 'duplicate'").count() == 1


def test_values_of_a_profile_are_counted_a_few_columns_at_a_time(spark, staging, monkeypatch):
    """the table of all values is not kept, and a profile does not depend on the columns in a pass."""
    rows = spark.createDataFrame([("a", "1", None), ("a", "2", " "), ("b", "2", "z")], "x string, resale_price string, y string")
    found = []
    for at_once in (1, 2, 8):
        monkeypatch.setattr(profile, "COLUMNS_AT_ONCE", at_once)
        found.append([str(r) for r in profile.column_profile(rows, staging).orderBy("position").collect()])
        assert "values" not in tables(staging.root)
    assert found[0] == found[1] == found[2] and len(found[0]) == 3


def test_a_snapshot_leaves_no_tables_of_its_build(spark, frame, shared):
    """while months are written only the decisions are staged beside them."""
    seen = []
    whole = incremental._write_months

    def watched(rows, folder):
        seen.append({n for p in shared.glob("siftworks-*") for n in tables(str(p))})
        return whole(rows, folder)

    incremental._write_months = watched
    try:
        snapshot = incremental.build(spark, frame({}, {"block": "8"}), JobConfig(), str(shared / "root"))
    finally:
        incremental._write_months = whole
    assert "decisions" in seen[0] and not {"master", "assessed", "marked", "logs"} & seen[0]
    assert snapshot.rows().count() == 2 and not [*shared.glob("siftworks-*")]


def test_a_gate_keeps_measures_only(spark, frame, shared):
    """the rows of one side are gone before the other is decided."""
    values, rates = evolution._measured_with(frame({}, {"block": "8"}, {"month": "2012-02", "town": "UNKNOWN"}), JobConfig())
    assert {n for p in shared.glob("siftworks-*") for n in tables(str(p))} == {"measured"}
    assert values.where("column = 'town'").first().n == 2
    assert rates.where("rate = 'stage:validation'").first().asDict() == {"rate": "stage:validation", "hits": 1, "rows": 3}
