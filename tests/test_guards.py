"""What stops a run, the command line, packaging, and plans that must not change."""

import sys
import tomllib
from pathlib import Path

import pytest
from conftest import BASE
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.operators import reports
from siftworks.plans import decide as plan
from siftworks.plans import job
from siftworks.presets import property_sales as sales
from siftworks.sources import files
from test_job import write

ROOT = Path(__file__).resolve().parents[1]


def test_rows_that_do_not_add_up_stop_the_run(spark, frame, tmp_path, staging, monkeypatch):
    counted = reports.decision_counts

    def lost(decisions):
        return counted(decisions).withColumn("quarantined_rows", F.col("quarantined_rows") + 1)

    monkeypatch.setattr(reports, "decision_counts", lost)
    with pytest.raises(RuntimeError, match="duplicated or lost"):
        job.publish_run(spark, frame({}, {"block": "8"}), JobConfig(), f"{tmp_path}/run", staging)


def test_scanned_rows_that_do_not_add_up_stop_the_run(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "a.csv", [BASE, {**BASE, "month": "2019-01"}])

    def short(*_, **__):
        empty = spark.createDataFrame([], "a int")
        return job.Published("run", [], None, empty, empty, {"master_rows": 0}, frozenset())

    monkeypatch.setattr(job, "publish_run", short)
    with pytest.raises(RuntimeError, match="do not add up"):
        job.run_job(spark, raw, tmp_path / "out")
    assert not (tmp_path / "out").exists()


def test_the_command_line_reaches_the_job(monkeypatch, capsys):
    seen = {}

    def ran(spark, source, target, config, **options):
        seen.update(source=source, target=target, config=config, **options)
        return {"counts": {"master_rows": 3}}

    monkeypatch.setattr(job, "build_session", lambda name: None)
    monkeypatch.setattr(job, "run_job", ran)
    job.main(["--input-dir", "in", "--output-dir", "out", "--start-month", "2011-01", "--reference-month", "2011-02",
              "--recursive", "--approvals", "a.csv", "--baseline", "current"])
    assert '"master_rows": 3' in capsys.readouterr().out
    assert seen == {
        "source": "in", "target": "out", "config": JobConfig("2011-01", "2016-12", "2011-02"),
        "recursive": True, "approvals": "a.csv", "baseline": "current"}
    with pytest.raises(SystemExit):
        job.main(["--no-such-option"])


def test_the_package_names_its_command():
    described = tomllib.loads((ROOT / "pyproject.toml").read_text())
    module, _, function = described["project"]["scripts"]["siftworks"].partition(":")
    assert callable(getattr(sys.modules[module], function))


def test_approvals_are_read_from_a_file(spark, tmp_path):
    path = tmp_path / "approvals.csv"
    path.write_text("kind,column,value,valid_from,valid_to,approver\nadd,town,CEDAR RISE,2013-01,,desk\n")
    assert [tuple(r) for r in job.read_approvals(spark, str(path)).collect()] == [
        ("add", "town", "CEDAR RISE", "2013-01", None, "desk")]
    path.write_text("column,kind,value,valid_from,valid_to,approver\ntown,add,CEDAR RISE,2013-01,,desk\n")
    with pytest.raises(Exception, match="CSV header|column names"):
        job.read_approvals(spark, str(path)).collect()


def test_one_odd_cell_does_not_send_a_column_to_python(frame, staging):
    wide = "".join(chr(ord(c) + 0xFEE0) if c.isalpha() else c for c in BASE["town"])
    rows = frame({}, *[{"block": str(i)} for i in range(30)], {"town": wide}, {"town": wide, "block": "9\u00b2"})
    known = plan.learn_reference(rows.limit(5), JobConfig(), staging, frozenset())
    composed = plan.compose_text(rows, plan.ascii_text_columns(rows), staging)
    judged = sales.assess(composed, known, JobConfig(), ascii_columns=plan.ascii_text_columns(rows))
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()
    found = {r["_source_row"]: r for r in judged.collect()}
    assert {r["town"] for r in found.values()} == {BASE["town"]} and found[33]["block"] == "92"
    assert found[32]["_raw"]["town"] == wide
    # The same by the join that a dictionary too large for broadcast needs.
    shuffled = plan.compose_text(rows, frozenset(), staging, broadcast_whole=False)
    column = sales.composed("town")
    pairs = lambda f: sorted((r["_source_row"], r[column]) for r in f.select("_source_row", column).collect())
    assert pairs(shuffled) == pairs(composed)


def test_log_folders_may_hold_other_files(spark, tmp_path):
    (tmp_path / "note.txt").write_text("x")
    (tmp_path / "12.json").write_text("{}")
    assert files.newest_in_log(spark, str(tmp_path)) is None
    assert files.append_to_log(spark, str(tmp_path), [1], after=0) == 1
    with pytest.raises(RuntimeError, match="moved on"):
        files.append_to_log(spark, str(tmp_path), [2], after=0)
