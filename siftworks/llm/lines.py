"""Line dedup by winnowing over line hashes.

A run is ``min_run`` or more consecutive lines. Every window of ``min_run`` lines
offers its smallest line hash (the last of equal ones) as a fingerprint, so two
equal windows always offer equal fingerprints at equal places. Fingerprints are
counted first: windows whose fingerprint occurs once in the table are done. The
others are compared as whole windows (128 bits of hash) with the first place of the same
window; adjacent matches merge into maximal runs. No fingerprint is selected from several
windows, and no match is extended from one: that would save rows, and find the same runs. Each place is compared with one first place only, never with all
others, so a line in every document costs one row per place.

A window is repeated if the same lines start at an earlier place: smaller id (null
last), then, within equal ids, smaller text hash, then earlier line. Lines covered by
a repeated window go. With ``long_line``, each line of at least so many words is a window
of its own too, so that a long passage goes although the lines around it differ; without
it, a repeated line between others, or alone in its document, stays. So the first place of a run stays, a document with a line in
a row many times keeps the first, and rows equal in id and text keep the same lines.

Results for odd input: a null text has no lines and stays null; an empty text is one
empty line; texts shorter than a run stay whole; an empty table gives an empty one.
Lines are what line feeds separate, compared exactly. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.common import staged
from siftworks.llm.mixing import word_count


def _digest(values: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), values)


def windows(documents: DataFrame, min_run: int, long_line: int | None = None) -> DataFrame:
    """Rows of windows: place (doc_id, text hash, start), size in lines, fingerprint, window hashes."""
    n = F.size("_h")
    starts = F.when(n >= min_run, F.sequence(F.lit(0), n - min_run)).otherwise(F.array().cast("array<int>"))
    spots = F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(min_run).alias("size")))
    if long_line is not None:
        # A line of so many words has that many characters, and as many but one between them.
        single = F.transform(F.split("text", "\n"), lambda line, i: F.when(
            F.length(line) >= 2 * long_line - 1,
            F.when(word_count(line) >= long_line, F.struct(i.alias("start"), F.lit(1).alias("size")))))
        spots = F.concat(spots, F.filter("_single", lambda spot: spot.isNotNull()))
    else:
        single = F.lit(None)
    hashes = F.transform(F.split("text", "\n"), lambda line: F.xxhash64(line))
    part = F.slice("_h", F.col("start") + 1, F.col("size"))
    # Windows of one line have fingerprints of their own: they match none of other sizes.
    smallest = F.array_min(part)
    if long_line is not None and min_run > 1:
        smallest = F.when(F.col("size") == 1, _digest(smallest, 3)).otherwise(smallest)
    return (
        documents.where(F.col("text").isNotNull())
        .select("doc_id", "_text", hashes.alias("_h"), F.transform(
            F.split("text", "\n"), lambda line: F.xxhash64(F.lit(7), line)).alias("_g"), single.alias("_single"))
        .select("doc_id", "_text", "_h", "_g", F.explode(spots).alias("_spot"))
        .select("doc_id", "_text", "_h", "_g", "_spot.start", "_spot.size")
        .select(
            "doc_id", "_text", "start", "size", smallest.alias("fingerprint"),
            _digest(part, 1).alias("w1"),
            _digest(F.slice("_g", F.col("start") + 1, F.col("size")), 2).alias("w2"),
        )
    )


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_text", "start")


def repeated_windows(documents: DataFrame, min_run: int, long_line: int | None = None) -> DataFrame:
    """Windows that start at an earlier place too: doc_id, _text, start, size."""
    rows = staged(windows(documents, min_run, long_line), "windows")
    # Smallest and largest place are combined before the shuffle, so a frequent
    # line is one row per task.
    shared = (
        rows.groupBy("fingerprint")
        .agg(F.min(F.xxhash64("doc_id", "_text", "start")).alias("_a"),
             F.max(F.xxhash64("doc_id", "_text", "start")).alias("_b"))
        .where("_a <> _b").select("fingerprint")
    )
    # Written first: the join then reads two plain shuffles, of which hot parts can be split.
    candidates = staged(rows.join(staged(shared, "fingerprints"), "fingerprint"), "shared")
    first = staged(candidates.groupBy("fingerprint", "w1", "w2").agg(F.min(_place()).alias("first")), "first")
    return (
        candidates.join(first, ["fingerprint", "w1", "w2"])
        .where(_place() > F.col("first"))
        .select("doc_id", "_text", "start", "size")
    )


def repeated_runs(documents: DataFrame, min_run: int = 2, long_line: int | None = None) -> DataFrame:
    """Maximal repeated runs: doc_id, _text, first_line, last_line (from 0)."""
    by_doc = Window.partitionBy("doc_id", "_text").orderBy("start", "size")
    end = F.col("start") + F.col("size")
    before = F.max(end).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.coalesce(F.col("start") > before, F.lit(True))
    return (
        repeated_windows(_keyed(documents), min_run, long_line).distinct()
        .withColumn("_run", F.sum(gap.cast("int")).over(by_doc))
        .groupBy("doc_id", "_text", "_run")
        .agg(F.min("start").alias("first_line"),
             (F.max(end) - 1).cast("int").alias("last_line"))
        .drop("_run")
    )


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumn("_text", F.xxhash64("text"))


def dedup_lines(documents: DataFrame, min_run: int = 2, long_line: int | None = None) -> DataFrame:
    """The input with ``text`` cut, and ``_sw_lines`` and ``_sw_removed`` counted."""
    runs = (
        repeated_runs(documents.select("doc_id", "text"), min_run, long_line)
        .groupBy("doc_id", "_text")
        .agg(F.array_sort(F.collect_list(F.struct("first_line", "last_line"))).alias("_sw_runs"))
        .select(F.col("doc_id").alias("_sw_id"), F.col("_text").alias("_sw_text"), "_sw_runs")
    )
    lines = F.split("text", "\n")
    # Before, between and after the runs.
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get("_sw_runs", i - 1)["last_line"] + 1)
    end = lambda i: F.coalesce(F.get("_sw_runs", i)["first_line"], F.size("_sw_all"))
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("_sw_runs")),
        lambda i: F.slice("_sw_all", begin(i) + 1, end(i) - begin(i))))
    removed = F.aggregate("_sw_runs", F.lit(0), lambda n, r: n + r["last_line"] - r["first_line"] + 1)
    joined = documents.join(
        runs, F.col("doc_id").eqNullSafe(F.col("_sw_id")) & (F.xxhash64("text") == F.col("_sw_text")), "left")
    return (
        joined.withColumn("_sw_all", lines)
        .withColumn("text", F.when(F.col("_sw_runs").isNull(), F.col("text"))
                    .otherwise(F.array_join(kept, "\n")))
        .withColumn("_sw_lines", F.coalesce(F.size("_sw_all"), F.lit(0)).cast("long"))
        .withColumn("_sw_lines", F.greatest("_sw_lines", F.lit(0)))
        .withColumn("_sw_removed", F.coalesce(removed, F.lit(0)).cast("long"))
        .drop("_sw_id", "_sw_text", "_sw_runs", "_sw_all")
    )
