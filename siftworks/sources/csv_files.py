"""CSV snapshots with differing headers, read as text with row lineage.

One scan per distinct header, or several where files are very many. Row numbers
come from counting rows per input split once and adding, for each row, the rows
before its split: files are numbered in a small dictionary, and a table of numbers
only, one row per split, is broadcast to each scan. So no file is sorted and no
row leaves its task to be numbered, however many splits there are.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftworks.config import JobConfig
from siftworks.functions.identity import record_id
from siftworks.functions.naming import col
from siftworks.functions.periods import is_month
from siftworks.functions.text import strip
from siftworks.presets import property_sales as sales
from siftworks.sources import files
from siftworks.staging import Staged, Staging

SOURCE_NOTE = "csv_snapshot"
_CHUNK = 8 * 1024 * 1024
_FILE_SCHEMA = "file string, uri string, bytes bigint"
_INSPECTED = "file string, uri string, bytes bigint, sha256 string, quotes bigint, header array<string>"
#: Splits and files read in one scan. Their offsets are 28 bytes a split, their names and digests
#: a row a file, so both tables can be broadcast; more files make more scans.
SPLITS_AT_ONCE, FILES_AT_ONCE = 500_000, 50_000
_MIN_SPLITS = "spark.sql.files.minPartitionNum"


@dataclass(frozen=True)
class SourceFile:
    """One input file and what a full read of its bytes showed."""

    file: str
    uri: str
    bytes: int
    sha256: str
    quotes: int
    header: tuple[str, ...]


def _open_bytes(uri: str):
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")
    from pyarrow import fs

    filesystem, path = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
    return filesystem.open_input_stream(path)


def _check_closed(uri: str) -> None:
    """Raise csv.Error if a quoted field is never closed; a quote within a plain field is fine."""
    csv.field_size_limit(1 << 30)
    with _open_bytes(uri) as stream:
        for _ in csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""), strict=True):
            pass


def _inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for item in batch.itertuples(index=False):
            digest, quotes, head = hashlib.sha256(), 0, None
            decoder = codecs.getincrementaldecoder("utf-8-sig")()
            try:
                with _open_bytes(item.uri) as stream:
                    while chunk := stream.read(_CHUNK):
                        digest.update(chunk)
                        quotes += chunk.count(b'"')
                        text = decoder.decode(chunk)
                        head = text if head is None else head
                decoder.decode(b"", final=True)
                if quotes % 2:
                    _check_closed(item.uri)
            except (UnicodeDecodeError, csv.Error) as error:
                raise ValueError(f"Malformed CSV file {item.file}: {error}") from error
            header = next(csv.reader(io.StringIO(head or "", newline="")), [])
            found.append((item.file, item.uri, item.bytes, digest.hexdigest(), quotes, header))
        yield pd.DataFrame(found, columns=["file", "uri", "bytes", "sha256", "quotes", "header"])


def inspect_files(spark: SparkSession, folder: str, recursive: bool = False) -> list[SourceFile]:
    """Digest and header of every CSV file, one streaming read per file on the executors."""
    listed = [
        item for item in files.listing(spark, folder, ".csv") if recursive or "/" not in item[0]
    ]
    if not listed:
        raise FileNotFoundError(f"Found no CSV file in {folder}")
    tasks = min(len(listed), max(spark.sparkContext.defaultParallelism * 4, 1))
    # Dealt out in turn from one list: hashing could put several large files in one task.
    table = spark.createDataFrame(listed, _FILE_SCHEMA).coalesce(1).repartition(tasks)
    rows = table.mapInPandas(_inspect, _INSPECTED).collect()
    inspected = [
        SourceFile(r.file, r.uri, r.bytes, r.sha256, r.quotes, tuple(r.header)) for r in rows
    ]
    return sorted(inspected, key=lambda f: f.file)


def check_header(source: SourceFile, required: Sequence[str], reserved: Sequence[str]) -> None:
    """Refuse a header the derived columns or the union schema could not live with."""
    header = source.header
    repeated = sorted({c for c in header if header.count(c) > 1})
    if repeated:
        raise ValueError(f"Duplicate CSV column names in {source.file}: {repeated}")
    missing = sorted(set(required) - set(header))
    if missing:
        raise ValueError(f"Missing required columns in {source.file}: {missing}")
    taken = sorted(c for c in header if c.startswith("_") or c in reserved)
    if taken:
        raise ValueError(f"Columns of {source.file} collide with derived fields: {taken}")


def refuse_case_twins(columns: Sequence[str], reserved: Sequence[str]) -> None:
    """Refuse names that differ in case only, from each other or from a derived field."""
    seen = {c.lower(): c for c in reserved}
    for column in columns:
        twin = seen.setdefault(column.lower(), column)
        if twin != column:
            raise ValueError(f"Column names differ in case only: {sorted([twin, column])}")


def _literal_path(uri: str) -> str:
    """A path the reader will not take for a pattern."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in uri)


def _path_key(path: Column) -> Column:
    """Readers spell local URIs with one or three slashes."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def _spans_lines(spark: SparkSession, sources: Sequence[SourceFile]) -> set[str]:
    """Files with a quoted line break: some physical line has an odd number of quotes."""
    quoted = [s for s in sources if s.quotes]
    if not quoted:
        return set()
    lines = spark.read.text([_literal_path(s.uri) for s in quoted])
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    odd = (
        lines.where(quotes % 2 == 1)
        .select(_path_key(F.col("_metadata.file_path")).alias("path"))
        .distinct()
    )
    return {row.path for row in odd.collect()}


def _read(spark: SparkSession, group: Sequence[SourceFile], multi_line: bool) -> DataFrame:
    header = group[0].header
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in header],
        # Catches rows longer than the header, which the reader would cut silently.
        T.StructField("_overflow", T.StringType()),
    ])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("multiLine", multi_line)
        .csv([_literal_path(s.uri) for s in group])
    )
    return rows.select(
        # A short row or an unquoted empty field is an empty text, not a missing one.
        *[F.coalesce(col(c), F.lit("")).alias(c) for c in header],
        "_overflow",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
    )


@dataclass(frozen=True)
class Scan:
    """The scoped master table and what the scan counted."""

    master: DataFrame
    columns: list[str]
    sources: list[SourceFile]
    inventory: DataFrame


def scan_csv(
    spark: SparkSession,
    folder: str,
    config: JobConfig,
    staging: Staging,
    *,
    required: Sequence[str] = sales.REQUIRED,
    reserved: Sequence[str] = sales.RESERVED,
    period: str = "month",
    recursive: bool = False,
) -> Scan:
    """Read every CSV of a folder into one all-text table.

    Rows of well-formed months outside the scope are counted and left out; rows
    with a malformed month stay in, to be quarantined. Files outside the scope
    still contribute their columns.
    """
    sources = inspect_files(spark, folder, recursive)
    for source in sources:
        check_header(source, required, reserved)
    if spark.conf.get(_MIN_SPLITS, None) is None:
        # Both passes below must cut files at the same places, even if the
        # number of executors changes in between.
        spark.conf.set(_MIN_SPLITS, str(spark.sparkContext.defaultParallelism))
    columns = sorted({c for s in sources for c in s.header})
    refuse_case_twins(columns, reserved)
    spanning = _spans_lines(spark, sources)
    parts = [_read(spark, group, multi) for group, multi in _scans(spark, sources, spanning)]
    blocks = staging.write(
        _union([
            _block_counts(part, period, config).withColumn("scan", F.lit(number)) for number, part in enumerate(parts)
        ]), "blocks"
    )
    long_rows = blocks.frame.where(F.col("overflow") > 0).select("_path").limit(1).collect()
    if long_rows:
        raise ValueError(f"A row is longer than the header: {long_rows[0]._path}")
    known = spark.createDataFrame(
        [(_local_key(s.uri), i, s.file, s.sha256, s.bytes, list(s.header)) for i, s in enumerate(sources)],
        "_key string, _file int, _source_file string, _source_sha256 string, bytes bigint, header array<string>",
    )
    inventory = _inventory(blocks, known)
    named = staging.write(_dictionary(blocks, known), "files")
    offsets = staging.write(_offsets(blocks, named), "offsets")
    master = _union([
        _rows(part, columns, period, config, named, offsets, number) for number, part in enumerate(parts)])
    return Scan(master, columns, sources, inventory)


def _bytes(setting: str) -> int:
    """A size as Spark settings write it."""
    number, unit = re.fullmatch(r"([0-9]+)([a-z]*)", setting.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "t": 40, "tb": 40}[unit]


def _scans(
    spark: SparkSession, sources: Sequence[SourceFile], spanning: set[str]
) -> list[tuple[list[SourceFile], bool]]:
    """Files to read together: of one header, and few enough for their offsets to be broadcast."""
    widest = max(_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")), 1)
    # A scan smaller than all cores is cut into about this many further splits.
    spare = int(spark.conf.get(_MIN_SPLITS))
    grouped: dict[tuple, list[SourceFile]] = {}
    for source in sources:
        grouped.setdefault((source.header, _local_key(source.uri) in spanning), []).append(source)
    scans = []
    for (_, multi), group in grouped.items():
        scans.append(([], multi))
        splits = spare
        for source in group:
            more = 1 if multi else -(-source.bytes // widest) + 1
            if scans[-1][0] and (splits + more > SPLITS_AT_ONCE or len(scans[-1][0]) >= FILES_AT_ONCE):
                scans.append(([], multi))
                splits = spare
            scans[-1][0].append(source)
            splits += more
    return scans


def _local_key(uri: str) -> str:
    scheme, _, rest = uri.partition(":")
    return "file:/" + rest.lstrip("/") if scheme == "file" else uri


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _in_scope(month: Column, config: JobConfig) -> Column:
    return month.between(config.start_month, config.end_month)


def _block_counts(part: DataFrame, period: str, config: JobConfig) -> DataFrame:
    rows = part.select(
        "_path", "_block", "_position", "_overflow", strip(F.col(period)).alias("_m")
    ).withColumn("_ok", is_month(F.col("_m")))
    inside = F.col("_ok") & _in_scope(F.col("_m"), config)
    dated = F.when(F.col("_ok"), F.col("_m"))
    return rows.groupBy("_path", "_block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_position").alias("first_position"),
        F.count_if(inside).alias("in_scope"),
        F.count_if(~F.col("_ok")).alias("invalid"),
        F.min(dated).alias("min_month"),
        F.max(dated).alias("max_month"),
        F.count("_overflow").alias("overflow"),
    )


def _inventory(blocks: Staged, known: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    counted = blocks.frame.groupBy(_path_key(F.col("_path")).alias("_key")).agg(
        F.sum("n").alias("rows"),
        F.sum("in_scope").alias("in_scope_rows"),
        F.sum("invalid").alias("invalid_date_rows"),
        F.min("min_month").alias("min_month"),
        F.max("max_month").alias("max_month"),
    )
    filled = known.join(counted, "_key", "left").withColumns({
        c: F.coalesce(c, zero) for c in ("rows", "in_scope_rows", "invalid_date_rows")
    })
    outside = F.col("rows") - F.col("in_scope_rows") - F.col("invalid_date_rows")
    return filled.select(
        F.col("_source_file").alias("file"), "bytes", F.col("_source_sha256").alias("sha256"),
        "rows", "in_scope_rows", "invalid_date_rows", outside.alias("out_of_scope_rows"),
        "min_month", "max_month", F.col("header").alias("columns"),
        F.lit(SOURCE_NOTE).alias("source"),
    )


def _dictionary(blocks: Staged, known: DataFrame) -> DataFrame:
    """One row per file: its path as the reader spells it, a number, its name and digest."""
    paths = blocks.frame.groupBy("scan", "_path").agg(F.sum("n").alias("n"))
    keyed = paths.select("scan", "_path", _path_key(F.col("_path")).alias("_key"))
    return keyed.join(known.select("_key", "_file", "_source_file", "_source_sha256"), "_key").drop("_key")


def _offsets(blocks: Staged, named: Staged) -> DataFrame:
    """Numbers only, one row per split: its file and start, the rows before it, its first position."""
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint"))
    placed = blocks.frame.select(
        "scan", "_path", F.col("_block").alias("_sw_block"), F.col("first_position").alias("_sw_first"),
        before.alias("_sw_before"),
    )
    return placed.join(named.frame.select("_path", "_file"), "_path").select(
        "scan", F.col("_file").alias("_sw_file"), "_sw_block", (F.col("_sw_before") - F.col("_sw_first")).alias("_sw_shift"))


def _rows(
    part: DataFrame, columns: Sequence[str], period: str, config: JobConfig, named: Staged, offsets: Staged,
    number: int,
) -> DataFrame:
    """Numbered rows of one scan, by two small tables that its files were chosen to keep small."""
    month = strip(F.col(period))
    wanted = part.where(~is_month(month) | _in_scope(month, config))
    mine = F.col("scan") == number
    files_ = named.frame.where(mine).select(
        F.col("_path").alias("_sw_path"), "_file", "_source_file", "_source_sha256")
    shifts = offsets.frame.where(mine).drop("scan")
    placed = wanted.join(F.broadcast(files_), F.col("_path") == F.col("_sw_path"), "left").join(
        F.broadcast(shifts), (F.col("_file") == F.col("_sw_file")) & (F.col("_block") == F.col("_sw_block")), "left")
    row = F.col("_position") + F.col("_sw_shift") + 1
    row = F.coalesce(row, F.raise_error(F.lit("input changed while it was read")).cast("bigint"))
    numbered = placed.withColumn("_source_row", row)
    present = set(part.columns)
    return numbered.select(
        *[
            col(c) if c in present else F.lit(None).cast("string").alias(c)
            for c in columns
        ],
        "_source_row",
        "_source_file",
        "_source_sha256",
        record_id(
            F.col("_source_file"), F.col("_source_sha256"), F.col("_source_row")
        ).alias("_source_record_id"),
    )
