"""Small driver-side file operations on whatever filesystem a path names."""

from __future__ import annotations

import hashlib
import json
import re
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute URI of a path, with no trailing slash and no dot segments."""
    fs, location = _open(spark, str(path))
    return fs.makeQualified(location).toUri().normalize().toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _open(spark, path)
    return fs.exists(location)


def size(spark: SparkSession, path: str) -> int:
    fs, location = _open(spark, path)
    return fs.getContentSummary(location).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, location = _open(spark, path)
    fs.delete(location, True)


def listing(spark: SparkSession, folder: str, suffix: str) -> list[tuple[str, str, int]]:
    """(path relative to the folder, URI, bytes) of every matching file, sorted."""
    fs, location = _open(spark, folder)
    if not fs.exists(location):
        return []
    base = fs.makeQualified(location).toUri().getPath().rstrip("/") + "/"
    found, iterator = [], fs.listFiles(location, True)
    while iterator.hasNext():
        status = iterator.next()
        uri = status.getPath().toUri()
        relative = uri.getPath()[len(base):]
        hidden = any(part.startswith(("_", ".")) for part in relative.split("/"))
        if relative.endswith(suffix) and not hidden:
            found.append((relative, status.getPath().toString(), status.getLen()))
    return sorted(found)


def folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders right below a folder."""
    fs, location = _open(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name, then rename it into place."""
    fs, location = _open(spark, path)
    _, pending = _open(spark, f"{path}.pending")
    stream = fs.create(pending, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(location):
        fs.delete(location, False)
    if not fs.rename(pending, location):
        raise OSError(f"Could not publish {path}")


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False) + "\n")


def read_json(spark: SparkSession, path: str) -> Any:
    """One small document, such as a run marker."""
    fs, location = _open(spark, path)
    stream = fs.open(location)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


_ENTRY = re.compile(r"([0-9]{8,})\.json")


def _entries(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and paths of a log's documents, newest first."""
    fs, location = _open(spark, folder)
    if not fs.exists(location):
        return []
    paths = [status.getPath() for status in fs.listStatus(location)]
    named = [(_ENTRY.fullmatch(p.getName()), p.toString()) for p in paths]
    return sorted(((int(m[1]), p) for m, p in named if m), reverse=True)


def _sealed(value: Any) -> bytes:
    body = json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False).encode()
    return body + b"\n" + hashlib.sha256(body).hexdigest().encode() + b"\n"


def _unsealed(content: bytes) -> Any:
    """The document, or None if any of it is missing."""
    body, _, seal = content.rstrip(b"\n").rpartition(b"\n")
    return json.loads(body) if hashlib.sha256(body).hexdigest().encode() == seal else None


def append_to_log(spark: SparkSession, folder: str, value: Any, *, after: int | None = None) -> int:
    """Add a numbered document and return its number.

    No document is ever replaced: a number that is taken, by a whole document or by one whose
    writer died, is passed over. With ``after``, the newest whole document must still have that
    number (0 for none), so that of two writers who began from the same state one fails. Two that
    both pass that test cannot both create the next number, where the file system creates files
    exclusively.
    """
    newest = newest_in_log(spark, folder)
    if after is not None and (newest[0] if newest else 0) != after:
        raise RuntimeError(f"{folder} has moved on from document {after}")
    number = max((n for n, _ in _entries(spark, folder)), default=0) + 1
    while True:
        fs, location = _open(spark, f"{folder}/{number:08d}.json")
        try:
            stream = fs.create(location, False)
        except Py4JJavaError:
            if not fs.exists(location):
                raise
            if after is not None:
                raise RuntimeError(f"Another writer is adding to {folder}") from None
            number += 1
            continue
        try:
            stream.write(bytearray(_sealed(value)))
        finally:
            stream.close()
        return number


def newest_in_log(spark: SparkSession, folder: str) -> tuple[int, Any] | None:
    """Number and content of the newest whole document of a log."""
    for number, path in _entries(spark, folder):
        fs, location = _open(spark, path)
        stream = fs.open(location)
        try:
            content = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        if (value := _unsealed(content)) is not None:
            return number, value
    return None
