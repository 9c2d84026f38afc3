"""Refreshed snapshots, versioned domains, the baseline gate and the log of manifests."""

import math
import random

import pytest
from conftest import BASE

from siftworks.config import JobConfig
from siftworks.operators import drift
from siftworks.operators.versions import APPROVALS, check_approvals, domain_versions
from siftworks.plans import baseline, incremental, job
from siftworks.plans import decide as plan
from siftworks.presets import property_sales as sales
from siftworks.sources import files
from siftworks.sources.csv_files import scan_csv
from test_job import write

CONFIG = JobConfig(anomaly_min_peers=4)
MONTHS = ["2012-01", "2012-05", "2013-02", "2014-07", "spring"]


def sale(draw, i):
    month = draw.choice(MONTHS)
    return {
        **BASE, "month": month, "block": str(draw.randrange(1, 30)), "town": draw.choice(["ALDER GROVE", "BIRCH END"]),
        "flat_type": draw.choice(["4 ROOM", "5 ROOM"]),
        "resale_price": str(draw.choice([300000, 310000, 320000 + i, 330000, 99, -1])),
    }


REFERENCE = [{**BASE, "town": t, "flat_type": f} for t in ("ALDER GROVE", "BIRCH END") for f in ("4 ROOM", "5 ROOM")]


def master(spark, records):
    """Rows by number; a number keeps its record id whatever its values."""
    names = sorted(BASE)
    data = [(*[r[n] for n in names], i, "feed", "digest", f"row-{i}") for i, r in sorted(records.items())]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(
        data, f"{schema}, _source_row bigint, _source_file string, _source_sha256 string, _source_record_id string")


def contents(snapshot):
    rows = snapshot.rows()
    return sorted(str(r.asDict(recursive=True)) for r in rows.select(*sorted(rows.columns)).collect())


def change(spark, before, after):
    """Added and removed rows between two states."""
    added = {i: r for i, r in after.items() if before.get(i) != r}
    gone = [(f"row-{i}", r["month"]) for i, r in before.items() if after.get(i) != r]
    removed = spark.createDataFrame(gone, "_source_record_id string, month string")
    return master(spark, added), removed


@pytest.fixture(scope="module")
def feed():
    draw = random.Random(11)
    return {i: r for i, r in enumerate(REFERENCE + [sale(draw, i) for i in range(160)], 1)}


def test_a_refresh_equals_a_full_build(spark, tmp_path, feed):
    draw = random.Random(3)
    root = str(tmp_path / "kept")
    state = incremental.build(spark, master(spark, feed), CONFIG, root)
    before = feed
    for step in range(2):
        after = dict(before)
        for i in draw.sample(sorted(i for i in before if i > 4), 8):
            kind = draw.randrange(3)
            if kind == 0:
                del after[i]
            elif kind == 1:
                after[i] = {**before[i], "resale_price": "305000"}
            else:
                after[500 + 20 * step + i] = sale(draw, i)
        state = incremental.refresh(spark, root, *change(spark, before, after))
        whole = incremental.build(spark, master(spark, after), CONFIG, str(tmp_path / f"whole-{step}"))
        assert contents(state) == contents(whole)
        before = after
    assert state.number == 3


def test_only_months_that_change_are_written(spark, tmp_path, feed):
    root, config = str(tmp_path), JobConfig()
    first = incremental.build(spark, master(spark, feed), config, root)
    # An invalid row is no peer and no duplicate, so nothing beyond its month can change.
    after = {**feed, 900: {**BASE, "month": "2013-02", "resale_price": "-1"}}
    second = incremental.refresh(spark, root, *change(spark, feed, after))
    assert second.rewritten == ["2013-02"]
    # Another writer that began from the first snapshot too comes late.
    with pytest.raises(RuntimeError, match="moved on"):
        files.append_to_log(spark, f"{root}/snapshots", {}, after=first.number)
    assert {m for m in second.months if second.months[m] != first.months[m]} == {"2013-02"}
    # Groups of a year are too small here: a new price moves fences that all years share.
    priced = {**after, 901: {**BASE, "month": "2013-02", "resale_price": "800000", "block": "77"}}
    third = incremental.refresh(spark, root, *change(spark, after, priced))
    assert {"2013-02", "2012-05"} <= set(third.rewritten) and "spring" not in third.rewritten
    assert third.months["malformed"] == first.months["malformed"]
    assert contents(third) == contents(
        incremental.build(spark, master(spark, priced), config, str(tmp_path / "whole")))


def test_a_new_winner_and_an_emptied_month(spark, tmp_path, feed):
    root = str(tmp_path / "a")
    extra = {i: {**BASE, "month": "2015-01", "block": "5", "resale_price": p} for i, p in ((700, "310000"), (701, "320000"))}
    before = feed | extra
    incremental.build(spark, master(spark, before), CONFIG, root)
    after = {i: r for i, r in before.items() if i != 701}
    lost = incremental.refresh(spark, root, *change(spark, before, after))
    row = lost.rows(["2015-01"]).first()
    assert (row["_source_row"], row["_quarantine_stage"], row["_reference_source_record_id"]) == (700, None, None)
    empty = incremental.refresh(spark, root, *change(spark, after, feed))
    assert "2015-01" not in empty.months
    assert contents(empty) == contents(incremental.build(spark, master(spark, feed), CONFIG, str(tmp_path / "b")))


def test_a_changed_domain_decides_all_rows_again(spark, tmp_path, feed):
    root = str(tmp_path / "a")
    incremental.build(spark, master(spark, feed), CONFIG, root)
    after = {**feed, 950: {**BASE, "town": "CEDAR RISE"}, 951: {**BASE, "month": "2014-07", "town": "CEDAR RISE"}}
    state = incremental.refresh(spark, root, *change(spark, feed, after))
    assert set(state.rewritten) == set(state.months)
    assert contents(state) == contents(incremental.build(spark, master(spark, after), CONFIG, str(tmp_path / "b")))


# --- versions -------------------------------------------------------------------------------


def approved(spark, *rows):
    return spark.createDataFrame(list(rows), APPROVALS)


def held(spark, versions, value, month):
    rows = [r for r in versions if r.value == value and r.valid_from <= month and (r.valid_to is None or month < r.valid_to)]
    return max((r.version for r in rows), default=None)


def test_intervals_of_versions(spark):
    reference = spark.createDataFrame([("town", "OLD", 3), ("town", "GONE", 1)], "column string, value string, n bigint")
    rows = domain_versions(reference, approved(
        spark, ("add", "town", " new  town", "2013-01", "2014-01", "x"), ("add", "town", "NEW TOWN", "2013-06", None, "y"),
        ("end", "town", "GONE", "2013-03", None, "x"), ("add", "town", "GONE", "2015-01", None, "z"),
        ("end", "town", "NEW TOWN", "2016-01", None, "z"))).collect()
    want = {
        ("OLD", "2019-01"): 0, ("GONE", "2013-02"): 0, ("GONE", "2013-03"): None, ("GONE", "2015-01"): 4,
        ("NEW TOWN", "2012-12"): None, ("NEW TOWN", "2013-05"): 1, ("NEW TOWN", "2013-07"): 3,
        ("NEW TOWN", "2014-02"): 3, ("NEW TOWN", "2016-01"): None,
    }
    assert {k: held(spark, rows, *k) for k in want} == want


@pytest.mark.parametrize("bad", [
    ("plus", "town", "A", "2013-01", None, "x"), ("add", "lane", "A", "2013-01", None, "x"),
    ("add", "town", " ", "2013-01", None, "x"), ("add", "town", "A", "2013-13", None, "x"),
    ("add", "town", "A", "2013-01", "2013-01", "x"), ("add", "town", "A", "2013-01", None, None),
    ("end", "town", "A", "2013-01", "2014-01", "x"), ("add", "town", None, "2013-01", None, "x"),
])
def test_bad_approvals_are_refused(spark, bad):
    with pytest.raises(ValueError, match="bad field"):
        check_approvals(approved(spark, bad), sales.CATEGORIES)


def test_a_value_is_not_approved_twice_from_one_month(spark):
    twice = approved(spark, ("add", "town", "a", "2013-01", None, "x"), ("add", "town", "A ", "2013-01", None, "y"))
    with pytest.raises(ValueError, match="twice"):
        check_approvals(twice, sales.CATEGORIES)


def test_rows_are_judged_by_the_version_of_their_month(spark, frame, staging):
    rows = frame(
        {}, {"month": "2013-05", "town": "CEDAR RISE"}, {"month": "2013-06", "town": "cedar  rise"},
        {"month": "2014-06", "town": "CEDAR RISE"}, {"month": "spring", "town": "CEDAR RISE"})
    approvals = approved(spark, ("add", "town", "cedar rise", "2013-06", "2014-06", "desk"))
    known = plan.learn_reference(rows, JobConfig(), staging, frozenset(), approvals)
    judged = sales.assess(rows, known, JobConfig()).orderBy("_source_row").select("_quarantine_reasons").collect()
    unknown = ["not_in_reference:town"]
    assert [r[0] for r in judged] == [[], unknown, [], unknown, ["invalid_date", *unknown, "lease_outside_0_to_99_years"]]


# --- gate -----------------------------------------------------------------------------------


def counts(spark, **values):
    return spark.createDataFrame([("c", v, n) for v, n in values.items()], "column string, value string, n bigint")


def test_distances_of_known_distributions(spark):
    row = drift.distances(counts(spark, a=1, b=1), counts(spark, a=2, b=2)).first()
    assert (row.shift, row.divergence, row.new_share) == (0, 0, 0)
    apart = drift.distances(counts(spark, a=3), counts(spark, b=5)).first()
    assert (apart.shift, apart.divergence, apart.new_share) == (1, 1, 1)
    half = drift.distances(counts(spark, a=1, b=1), counts(spark, a=3, b=1)).first()
    want = 0.5 * sum(x * math.log2(x / ((x + y) / 2)) for x, y in ((.5, .75), (.75, .5), (.5, .25), (.25, .5)))
    assert half.shift == pytest.approx(.25) and half.divergence == pytest.approx(want)
    none = spark.createDataFrame([], "column string, value string, n bigint")
    assert drift.distances(counts(spark, a=1), none).first().shift == 1


def rates(spark, *rows):
    return spark.createDataFrame(list(rows), "rate string, hits bigint, rows bigint")


def test_a_rate_fails_only_if_large_and_significant(spark):
    old = rates(spark, ("few", 1, 20), ("many", 1000, 100000), ("far", 1000, 100000), ("same", 0, 10), ("none", 0, 0))
    new = rates(spark, ("few", 4, 20), ("many", 1200, 100000), ("far", 5000, 100000), ("same", 0, 10), ("none", 0, 0))
    values = counts(spark, a=1)
    checks = {r.check: r for r in drift.gate(values, values, old, new, drift.Thresholds()).collect()}
    assert {n: checks[f"rate:{n}"].passed for n in ("few", "many", "far", "same", "none")} == {
        "few": True, "many": True, "far": False, "same": True, "none": True}
    pooled = 6000 / 200000
    assert checks["rate:far"].statistic == pytest.approx(.04 / math.sqrt(pooled * (1 - pooled) * 2 / 100000))
    assert checks["rows"].passed


def test_thresholds_are_checked():
    with pytest.raises(ValueError):
        drift.Thresholds(shift=0)
    with pytest.raises(ValueError):
        drift.Thresholds(rows=.5)


def test_a_drifted_run_gets_no_manifest(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    rows = [{**BASE, "block": str(i), "flat_type": "4 ROOM" if i % 2 else "5 ROOM"} for i in range(40)]
    approvals = tmp_path / "approvals.csv"
    approvals.write_text("kind,column,value,valid_from,valid_to,approver\nadd,town,CEDAR RISE,2013-01,,desk\n")
    write(raw / "a.csv", [*rows, {**BASE, "month": "2013-06", "town": "cedar rise"}])
    first = job.run_job(spark, raw, out, approvals=str(approvals))
    assert first["counts"]["cleaned_rows"] == 41 and all(c["passed"] for c in first["checks"])
    versions = spark.read.option("header", True).csv(f"{first['run']}/reports/reference_versions")
    assert [tuple(r) for r in versions.where("version > 0").select("value", "approver").collect()] == [("CEDAR RISE", "desk")]
    assert job.marker_checks(spark, str(out)) == [("manifest_names_whole_run", 5, 0)]
    write(raw / "a.csv", [{**r, "flat_type": "4 ROOM" if i > 2 else "5 ROOM"} for i, r in enumerate(rows)])
    with pytest.raises(baseline.QualityGate, match="shift:flat_type"):
        job.run_job(spark, raw, out, baseline="current")
    assert job.current_run(spark, str(out))["run"] == first["run"]
    # The same measures but for a column more.
    run, other = first["run"], str(tmp_path / "other")
    for name in (baseline.VALUES, baseline.RATES):
        spark.read.parquet(f"{run}/{name}").write.parquet(f"{other}/{name}")
    columns = files.read_json(spark, f"{run}/{baseline.COLUMNS}")
    for named, failing in ((columns, []), ([*columns, "new_column"], ["schema"])):
        files.write_json(spark, f"{other}/{baseline.COLUMNS}", named)
        checks = baseline.compare_runs(spark, run, other, drift.Thresholds()).collect()
        assert [c.check for c in checks if not c.passed] == failing
    killed_after_the_manifest(spark, str(out), first)


def killed_after_the_manifest(spark, out, first):
    """A writer that dies before its marker leaves a readable run, whose counts are checked."""
    def killed(*_):
        raise KeyboardInterrupt

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(files, "write_text", killed)
        with pytest.raises(KeyboardInterrupt):
            job.publish_manifest(spark, out, {"run": first["run"], "counts": {"master_rows": 9}})
    assert job.current_run(spark, out)["counts"] == {"master_rows": 9}
    job.publish_manifest(spark, out, {"run": first["run"], "counts": {**first["counts"], "cleaned_rows": 9}})
    assert job.marker_checks(spark, out) == [("manifest_names_whole_run", 5, 1)]


# --- log ------------------------------------------------------------------------------------


def test_a_killed_writer_leaves_the_log_readable(spark, tmp_path):
    folder = str(tmp_path)
    assert files.newest_in_log(spark, folder) is None
    assert files.append_to_log(spark, folder, {"a": 1}) == 1
    for half in ("", '{"a": 2', '{"a": 2}\n', '{"a": 2}\n0123\n'):
        number = len(list(tmp_path.glob("*.json"))) + 1
        (tmp_path / f"{number:08d}.json").write_text(half)
        assert files.newest_in_log(spark, folder) == (1, {"a": 1})
    assert files.append_to_log(spark, folder, {"a": "ü\n"}) == 6
    assert files.newest_in_log(spark, folder) == (6, {"a": "ü\n"})


# --- split offsets --------------------------------------------------------------------------


def test_many_scans_number_rows_without_moving_them(spark, tmp_path, staging, monkeypatch):
    from siftworks.sources import csv_files

    for f in range(5):
        write(tmp_path / f"{f}.csv", [{**BASE, "block": f"{f}-{i}"} for i in range(60 + f)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    monkeypatch.setattr(csv_files, "SPLITS_AT_ONCE", 12)
    monkeypatch.setattr(csv_files, "FILES_AT_ONCE", 2)
    try:
        scan = scan_csv(spark, str(tmp_path), CONFIG, staging)
        rows = scan.master.select("_source_file", "_source_row", "block").collect()
        plan_text = scan.master._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spark.read.parquet(f"{staging.root}/blocks-*").count() > 20
    want = {(f"{f}.csv", i + 1, f"{f}-{i}") for f in range(5) for i in range(60 + f)}
    assert {(r["_source_file"], r["_source_row"], r["block"]) for r in rows} == want and len(rows) == len(want)
    assert plan_text.count("FileScan csv") >= 3
    assert "Exchange hashpartitioning" not in plan_text and "SortMergeJoin" not in plan_text
