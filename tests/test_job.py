"""CSV in, published run out."""

import csv
import gzip
import hashlib
import json
from pathlib import Path

import pytest
from conftest import BASE
from pyspark.sql import functions as F

from siftworks.config import JobConfig
from siftworks.plans import publish
from siftworks.plans.job import current_run, run_job
from siftworks.plans.verify import contract_checks
from siftworks.sources.csv_files import scan_csv
from siftworks.sources.tables import read_with_lineage


def write(path: Path, rows, columns=None):
    columns = columns or list(dict.fromkeys(c for row in rows for c in row))
    with path.open("w", newline="", encoding="utf-8") as stream:
        out = csv.DictWriter(stream, columns)
        out.writeheader()
        out.writerows(rows)


def digests(folder: Path):
    return {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.glob("*.csv")}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write(folder / "later.csv", [{**BASE, "month": "2019-06", "added_later": "yes"}])
    write(folder / "current.csv", [
        BASE, {**BASE, "resale_price": "298000"},
        {**BASE, "month": "2013-05", "block": "31", "town": " Un\nknown"},
        {**BASE, "month": "spring"},
    ])
    return folder


def test_a_run_accounts_for_every_row_and_repeats(spark, raw, tmp_path):
    before, out = digests(raw), tmp_path / "out"
    first = run_job(spark, raw, out)
    counts = first["counts"]
    assert (counts["raw_rows"], counts["out_of_scope_rows"], counts["master_rows"]) == (5, 1, 4)
    assert counts["cleaned_rows"] + counts["quarantined_rows"] == 4
    assert "added_later" in first["source_columns"]
    assert all(check["passed"] for check in first["checks"]) and len(first["checks"]) == 25
    assert digests(raw) == before
    marker = current_run(spark, str(out))
    assert marker["run"] == first["run"] and marker["input_sha256"] == before
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        second = run_job(spark, raw, out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert second["counts"] == counts and second["run"] != first["run"]
    for group in publish.GROUPS:
        old, new = (publish.read_group(spark, r["run"], group) for r in (first, second))
        assert sorted(map(str, old.collect())) == sorted(map(str, new.collect()))
    run = Path(second["run"].removeprefix("file:"))
    rows = [
        row
        for part in (run / "quarantined/csv").glob("*.gz")
        for row in csv.DictReader(gzip.open(part, "rt", newline=""))
    ]
    assert len(rows) == 3 and " Un\nknown" in {r["town"] for r in rows}
    assert json.loads((run / "reports/run_summary.json").read_text())["counts"] == counts


def test_damaged_output_fails_its_contracts(spark, raw, tmp_path, staging, frame):
    from siftworks.plans.job import key_hash, publish_run

    published = publish_run(
        spark, frame({}, {"resale_price": "1"}, {"month": "2012-02", "town": "UNKNOWN"}), JobConfig(),
        f"{tmp_path}/run", staging,
    )
    path = publish.dataset_path(published.run, "quarantined")
    kept = publish.read_group(spark, published.run, "quarantined").where("_source_row = 2")
    kept = staging.write(kept.withColumn("block", F.lit("7")), "kept").frame
    kept.write.mode("overwrite").parquet(path)
    checks = contract_checks(
        spark, published.run, published.columns, published.reference, JobConfig(),
        key_hash(published.columns),
    )
    failed = {r.check for r in checks.where("not passed").collect()}
    assert failed == {
        "row_has_one_outcome",
        "quarantine_text_unchanged",
        "copies_agree:quarantined",
    }


def test_headers_are_policed_before_reading(spark, tmp_path, staging):
    cases = {
        "incomplete": ("month\n2012-01\n", "Missing required"),
        "twice": ("month,month\n2012-01,2012-01\n", "Duplicate CSV column"),
        "taken": (",".join([*BASE, "_x"]) + "\n", "collide"),
        "reserved": (",".join([*BASE, "price_per_sqm"]) + "\n", "collide"),
        "long": (",".join(BASE) + "\n" + ",".join(BASE.values()) + ",9\n", "longer than the header"),
    }
    for name, (text, message) in cases.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "bad.csv").write_text(text)
        with pytest.raises(ValueError, match=message):
            scan_csv(spark, str(folder), JobConfig(), staging)
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        scan_csv(spark, str(tmp_path / "none"), JobConfig(), staging)


def test_folders_may_not_contain_each_other(spark, tmp_path):
    for source, target in (("data/raw", "data"), ("data", "data/out"), ("data", "data")):
        with pytest.raises(ValueError, match="cannot contain"):
            run_job(spark, tmp_path / source, tmp_path / target)


def test_awkward_files_keep_their_row_numbers(spark, tmp_path, staging):
    """Byte order mark, CRLF, blank lines, doubled quotes, line breaks, short rows, odd names."""
    columns = ",".join(BASE)
    line = ",".join([*list(BASE.values())[:-1], "{}"])
    (tmp_path / "a b, (x)+1.csv").write_text(
        "﻿" + columns + "\r\n" + "".join(line.format(i) + "\r\n\r\n" for i in range(1, 500))
    )
    (tmp_path / "broken [1].csv").write_text(
        columns + ",note\n" + "".join(line.format(i) + f',"say ""{i}""\nagain"\n' for i in range(1, 50))
    )
    (tmp_path / "short.csv").write_text(
        columns + ",note\n" + line.format(1) + "\n" + line.format(2) + ",\n" + line.format(3) + ',""\n'
    )
    (tmp_path / "empty.csv").write_text(columns + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        scan = scan_csv(spark, str(tmp_path), JobConfig(), staging)
        master = staging.write(scan.master, "master").frame
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wrong = master.where(F.col("_source_row") != F.col("resale_price").cast("int"))
    assert wrong.count() == 0
    rows = {r["file"]: r["rows"] for r in scan.inventory.collect()}
    assert rows == {"a b, (x)+1.csv": 499, "broken [1].csv": 49, "short.csv": 3, "empty.csv": 0}
    notes = {(r._source_file, r.note) for r in master.where("_source_row = 1").collect()}
    assert notes == {
        ("a b, (x)+1.csv", None), ("broken [1].csv", 'say "1"\nagain'), ("short.csv", ""),
    }
    name = "a b, (x)+1.csv"
    listed = json.dumps([name, digests(tmp_path)[name], 7], separators=(",", ":"))
    row = master.where((F.col("_source_file") == name) & (F.col("_source_row") == 7)).first()
    assert row._source_record_id == hashlib.sha256(listed.encode()).hexdigest()


def test_parquet_rows_carry_lineage(spark, tmp_path):
    spark.range(0, 100, 1, 1).write.parquet(str(tmp_path / "t"))
    rows = read_with_lineage(spark, str(tmp_path / "t"), "d")
    assert rows.where(F.col("_source_row") != F.col("id") + 1).count() == 0
    assert rows.select("_source_record_id").distinct().count() == 100


@pytest.mark.parametrize("damage", [b"\xff\xfe", b'"never closed\n'])
def test_a_broken_file_stops_the_run_and_is_named(spark, raw, tmp_path, damage):
    with (raw / "current.csv").open("ab") as stream:
        stream.write(b"x" + damage if damage[:1] == b"\xff" else damage)
    with pytest.raises(Exception, match="Malformed CSV file current.csv"):
        run_job(spark, raw, tmp_path / "out")
    assert not (tmp_path / "out" / "_SUCCESS.json").exists()


def test_control_characters_and_lone_quotes_stay(spark, tmp_path, staging):
    folder = tmp_path / "raw"
    folder.mkdir()
    plain = {**BASE, "note": "\x01", "size": ""}
    write(folder / "a.csv", [plain])
    text = (folder / "a.csv").read_text(encoding="utf-8")
    last = text.splitlines()[-1].rsplit(",", 1)[0] + ',5" pipe\n'
    (folder / "a.csv").write_bytes((text + last).encode())
    found = scan_csv(spark, str(folder), JobConfig(), staging).master.orderBy("_source_row").collect()
    assert [(r.note, r["size"]) for r in found] == [("\x01", ""), ("\x01", '5" pipe')]


def test_any_source_column_name_works(spark, tmp_path):
    """Names the engine might use itself, or that need quoting, through every stage."""
    folder = tmp_path / "raw"
    folder.mkdir()
    odd = {c: f"<{c}>" for c in (
        "n", "winner", "sum_cents", "sale.note", "a b", "x`y", "before", "first_position", "k", "value", "rows",
    )}
    rows = [{**BASE, **odd, "block": str(i), "resale_price": str(250000 + 900 * i)} for i in range(40)]
    rows += [rows[3], {**rows[4], "resale_price": "9000000", "n": "other"}, {**rows[5], "block": "none"}]
    write(folder / "a.csv", rows)
    done = run_job(spark, folder, tmp_path / "out")
    assert all(check["passed"] for check in done["checks"])
    counts = done["counts"]
    assert (counts["cleaned_rows"], counts["quarantined_rows"]) == (40, 3)
    for group in publish.GROUPS:
        got = publish.read_group(spark, done["run"], group)
        assert set(odd) <= set(got.columns)
        kept = {tuple(r[c] for c in odd if c != "n") for r in got.collect()}
        assert kept == {tuple(v for c, v in odd.items() if c != "n")}


def test_names_that_differ_in_case_only_are_refused(spark, tmp_path, staging):
    for name, extra in (("one", [{"Town": "x"}]), ("two", [{"note": "x"}, {"Note": "y"}]), ("three", [{"Price_Per_Sqm": "1"}])):
        folder = tmp_path / name
        folder.mkdir()
        for i, more in enumerate(extra):
            write(folder / f"{i}.csv", [{**BASE, **more}])
        with pytest.raises(ValueError, match="differ in case"):
            scan_csv(spark, str(folder), JobConfig(), staging)


def test_a_run_without_scope_or_survivors_stops(spark, tmp_path):
    for name, change, message in (
        ("late", {"month": "2020-01"}, "no row in scope"), ("bad", {"block": "none"}, "Every row was rejected"),
    ):
        (tmp_path / name).mkdir()
        write(tmp_path / name / "a.csv", [{**BASE, **change}])
        with pytest.raises(ValueError, match=message):
            run_job(spark, tmp_path / name, tmp_path / f"{name}-out")
        assert not (tmp_path / f"{name}-out" / publish.MARKER).exists()
