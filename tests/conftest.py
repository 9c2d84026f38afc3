from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siftworks.config import JobConfig  # noqa: E402
from siftworks.plans import stages  # noqa: E402
from siftworks.session import build_session  # noqa: E402
from siftworks.staging import Staging  # noqa: E402

BASE = {
    "month": "2012-01", "town": "ALDER GROVE", "flat_type": "4 ROOM", "block": "27",
    "street_name": "ALDER WALK", "storey_range": "04 TO 06", "floor_area_sqm": "84",
    "flat_model": "STANDARD", "lease_commence_date": "1991", "resale_price": "312500",
}
CONFIG = JobConfig()


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    area = Staging(spark)
    yield area
    area.drop()


@pytest.fixture
def frame(spark):
    """Rows made from the base record by changing some values."""
    def build(*changes):
        records = [{**BASE, **change} for change in changes] or [dict(BASE)]
        names = sorted({name for record in records for name in record})
        data = [
            (*[record.get(name) for name in names], i, "source.csv", "source-hash", f"row-{i}")
            for i, record in enumerate(records, 1)
        ]
        schema = ", ".join(f"{name} string" for name in names)
        return spark.createDataFrame(
            data,
            f"{schema}, _source_row bigint, _source_file string, _source_sha256 string,"
            " _source_record_id string",
        )

    return build


@pytest.fixture
def judge(frame, staging):
    """Accepted and rejected rows against the domains of the base record."""
    def run(*changes, config=CONFIG):
        reference = stages.build_reference(frame(), config, staging)
        return stages.validate(frame(*changes), reference, config, staging)

    return run


@pytest.fixture
def accepted(judge):
    def run(*changes):
        return judge(*changes)[0].orderBy("_source_row")

    return run


@pytest.fixture
def reasons(judge):
    """The reasons of every row, by position; an accepted row has none."""
    def run(*changes, config=CONFIG):
        rejected = judge(*changes, config=config)[1]
        rows = rejected.select("_source_row", "_quarantine_reasons").collect()
        found = {row._source_row: row._quarantine_reasons for row in rows}
        return [found.get(i, []) for i in range(1, len(changes) + 1)]

    return run


@pytest.fixture
def evaluate(spark):
    """Apply a column function to a list of texts."""
    def run(function, values, kind="string"):
        data = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [row.r for row in data.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]

    return run
