"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.staging import Staging

#: Words are what ASCII white space separates; ``bytes.split()`` uses the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_text(text: str = "text"):
    """A text column as bytes, so that tasks read words without decoding."""
    return F.col(text).cast("binary")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(staging: Staging, frame: DataFrame, name: str) -> DataFrame:
    """Write a table; the write's own shuffle files go when it is done, as the table holds all."""
    conf = frame.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return staging.write(frame, name).frame
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    return _write(Staging(frame.sparkSession), frame, name)


class Scratch:
    """Tables that later steps of one block need, removed at its end."""

    def __init__(self, spark: SparkSession) -> None:
        self._staging = Staging(spark)

    def __call__(self, frame: DataFrame, name: str) -> DataFrame:
        return _write(self._staging, frame, name)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self._staging.drop()


#: Rows of a batch that are Python objects at once.
SLICE = 512


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, a slice of a batch at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield from zip(*[column.to_pylist() for column in batch.slice(at, SLICE).columns], strict=True)


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)],
        schema=schema,
    )
