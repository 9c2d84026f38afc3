"""Intermediate tables in the folder the cluster shares.

A staged table is plain Parquet under ``spark.checkpoint.dir``: it cuts the
lineage, survives lost executors, keeps column pruning and filter pushdown for
the passes that read it back, and gives Catalyst real sizes for its join
choices.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from siftworks.sources import files

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Digests of rows are hex text, which this codec halves and the default one leaves as it is.
DENSE = "zstd"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh local one only for local masters."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"Set {CHECKPOINT_KEY} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="siftworks-")
    return _local_folders[application]


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of each execution go when it ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Staged:
    """A written intermediate table, its measured size and what its write observed."""

    def __init__(self, spark: SparkSession, path: str, schema, metrics: dict) -> None:
        self.path = path
        self.metrics = metrics
        self._spark = spark
        self._schema = schema
        self._bytes: int | None = None
        self._rows: int | None = None

    @property
    def frame(self) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(self.path)

    @property
    def bytes(self) -> int:
        if self._bytes is None:
            self._bytes = files.size(self._spark, self.path)
        return self._bytes

    @property
    def rows(self) -> int:
        if self._rows is None:
            self._rows = self.frame.count()
        return self._rows

    def drop(self) -> None:
        """Remove the files; frames that read them are of no use afterwards."""
        files.delete(self._spark, self.path)


def write_observed(frame: DataFrame, path: str, codec: str = "snappy", /, **observed: Column) -> Staged:
    """Write Parquet and measure aggregates over the rows while they pass by."""
    seen = Observation()
    watched = frame.observe(seen, *[c.alias(n) for n, c in observed.items()]) if observed else frame
    watched.write.option("compression", codec).parquet(path)
    return Staged(frame.sparkSession, path, frame.schema, seen.get if observed else {})


class Staging:
    """One job's staging area; ``drop`` removes everything the job staged."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/siftworks-{uuid.uuid4().hex}"

    def write(self, frame: DataFrame, name: str, **observed: Column) -> Staged:
        """Write a table; the named aggregates are computed in the same pass."""
        return write_observed(frame, f"{self.root}/{name}-{uuid.uuid4().hex[:8]}", **observed)

    def write_wide(self, frame: DataFrame, name: str) -> Staged:
        """Write a table of whole rows, as many as the input has, in less room."""
        return write_observed(frame, f"{self.root}/{name}-{uuid.uuid4().hex[:8]}", DENSE)

    def drop(self) -> None:
        files.delete(self.spark, self.root)
