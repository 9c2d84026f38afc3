"""Substring dedup over a compacted De Bruijn graph of word k-mers.

An edge is a window of ``k`` words, from the node of its first to the node of its last
k - 1 words. Only edges that start in several documents matter. To find them without
moving every window, each window first names its anchor: the smallest hash among its
runs of ``ANCHOR`` words, which equal windows share. Consecutive windows mostly share
anchors too, so there are about a fifth as many; windows whose anchor stands in one
document only are done. Rows that are exact copies are set aside first: all their windows
start in the smallest of them; other texts of their ids stay. The other windows are edges, keyed by 96 bits of hash.

Of every repeated edge the first source place (smallest document, then word) is kept, and
joined to its other occurrences; each place meets one source, never all other places.
Edges that follow each other both in a document and at their source coordinates compact
into one path; where the two part, the graph branches and another path begins. A path
is thereby verified edge by edge along its source, and carries its coordinates. Words, edges
and texts are compared by hashes of 64, 96 and 128 bits, never letter by letter.

Rows of one id are told apart by a 64-bit key of their text. Before it is used, all rows are
grouped by id and key; should two texts of an id share one, another salt gives other keys.

A word is removed if a window that covers it also starts in a document with a smaller
id. All windows are judged on the input.

Results for odd input: null, empty and short texts have no windows and keep all words;
rows with a null id neither lose words nor are a source; rows with one id are one
document, so they don't remove each other's words, and equal rows get equal answers; an
empty table gives an empty one; very long texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.common import Scratch, raw_text, rows_of, staged
from siftworks.llm.mixing import word_count
from siftworks.llm.shingles import WordNumbers, runs

WINDOW, ANCHOR = 13, 5

KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def window_anchors(numbers: np.ndarray, k: int) -> np.ndarray:
    """The anchor of every window."""
    parts = runs(numbers, min(ANCHOR, k))
    windows = len(numbers) - k + 1
    if windows <= 0:
        return parts[:0]
    out = parts[:windows].copy()
    for i in range(1, k - min(ANCHOR, k) + 1):
        np.minimum(out, parts[i:i + windows], out=out)
    return out


def anchors(documents: DataFrame, salt: int, k: int) -> DataFrame:
    """(anchor, doc_id, text_key): the distinct anchors of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers()
        held: list[tuple[int, int, np.ndarray]] = []
        count = 0
        for doc, key, text in rows_of(batches):
            found = np.unique(window_anchors(numbers(text.split()), k))
            held.append((doc, key, found))
            count += len(found)
            if count > 500_000:
                yield _anchor_batch(held)
                held, count = [], 0
        if held:
            yield _anchor_batch(held)

    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.select("doc_id", text_key(salt), raw_text()).mapInArrow(run, "anchor long, doc_id long, text_key long")


def _anchor_batch(held: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    sizes = [len(f) for *_, f in held]
    docs = np.repeat(np.array([d for d, *_ in held], np.int64), sizes)
    keys = np.repeat(np.array([key for _, key, _ in held], np.int64), sizes)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([f for *_, f in held]).view(np.int64)), pa.array(docs), pa.array(keys)],
        names=["anchor", "doc_id", "text_key"])


def exact_copies(documents: DataFrame) -> tuple[DataFrame, int]:
    """Documents whose text a smaller id has too: doc_id, text_key, n_words, source; and the keys' salt."""
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", *_text_hashes(), word_count(F.col("text")).alias("n_words"))
    with Scratch(documents.sparkSession) as scratch:
        rows = scratch(rows, "texts")
        salt = 0
        while _shared_keys(rows, salt):
            salt += 1
        rows = rows.withColumn("text_key", text_key(salt, F.col("t1"), F.col("t2")))
        first = rows.groupBy("t1", "t2").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
        first = scratch(first.where("source < last").drop("last"), "first")
        copies = rows.join(first, ["t1", "t2"]).where("doc_id > source")
        return staged(copies.select("doc_id", "text_key", "n_words", "source"), "copies"), salt


def _text_hashes() -> list[Column]:
    """128 bits of hash, by which texts are taken as equal."""
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(5), "text").alias("t2")]


def text_key(salt: int, *hashes: Column) -> Column:
    """Tells rows of one id apart by their texts, under a salt with which no two of them agree."""
    t1, t2 = hashes or _text_hashes()
    return F.xxhash64(F.lit(salt), t1, t2).alias("text_key")


def _shared_keys(rows: DataFrame, salt: int) -> bool:
    """Do two different texts of one id have one key?"""
    seen = rows.groupBy("doc_id", text_key(salt, F.col("t1"), F.col("t2"))).agg(
        F.min("t1").alias("a1"), F.max("t1").alias("b1"), F.min("t2").alias("a2"), F.max("t2").alias("b2"))
    return not seen.where("a1 < b1 OR a2 < b2").isEmpty()


def shared_anchors(documents: DataFrame, copies: DataFrame, salt: int, k: int) -> DataFrame:
    """(doc_id, text_key, anchors): of texts that aren't exact copies, the anchors several documents have."""
    with Scratch(documents.sparkSession) as scratch:
        rows = scratch(anchors(documents, salt, k), "anchors")
        for without in (None, copies.select("doc_id", "text_key").distinct()):
            if without is not None:
                rows = scratch(rows.join(without, ["doc_id", "text_key"], "left_anti"), "originals")
            several = rows.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
            # Written first: the join then reads two plain shuffles, of which hot parts can be split.
            several = scratch(several.where("a < b").select("anchor"), "several")
            rows = scratch(rows.join(several, "anchor"), "shared")
        return staged(rows.groupBy("doc_id", "text_key").agg(F.collect_list("anchor").alias("anchors")), "of_doc")


def edges(documents: DataFrame, copies: DataFrame, salt: int, k: int) -> DataFrame:
    """Windows whose anchor stands in several documents: e1, e2 (96 bits of hash), doc_id, text_key, start."""
    of_doc = shared_anchors(documents, copies, salt, k)
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", text_key(salt), raw_text().alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers()
        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(),
                       batch.column("text"), batch.column("anchors"), strict=True)
            for doc, key, text, known in rows:
                own = numbers(text.as_py().split())
                known = known.values.to_numpy(zero_copy_only=False).view(np.uint64)
                start = np.flatnonzero(np.isin(window_anchors(own, k), known))
                held.append([runs(own, k, 1)[start].view(np.int64), runs(own, k, 2)[start].astype(np.uint32).view(np.int32),
                             np.full(len(start), doc), np.full(len(start), key, np.int64), start.astype(np.int32)])
                count += len(start)
                if count > 200_000:
                    yield _edge_batch(held)
                    held, count = [], 0
        if held:
            yield _edge_batch(held)

    return texts.join(of_doc, ["doc_id", "text_key"]).select(
        "doc_id", "text_key", "text", "anchors").mapInArrow(run, "e1 long, e2 int, doc_id long, text_key long, start int")


def _edge_batch(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(column)) for column in zip(*held, strict=True)],
        names=["e1", "e2", "doc_id", "text_key", "start"])


_SHIFT = 1 << 32


def sources(places: DataFrame) -> DataFrame:
    """Repeated edges with their first source place: e1, e2, source, source_start."""
    # One number per place, so that the smallest is kept in a hash table, without sorting.
    place = (F.col("doc_id").cast("decimal(20,0)") * (1 << 32) + F.col("start")).cast("decimal(38,0)")
    first = places.groupBy("e1", "e2").agg(F.min(place).alias("at"), F.max("doc_id").alias("last"))
    start = F.pmod("at", F.lit(_SHIFT).cast("decimal(38,0)"))
    return (
        first.withColumn("source_start", start.cast("int"))
        .withColumn("source", ((F.col("at") - start) / F.lit(_SHIFT).cast("decimal(11,0)")).cast("long"))
        .where("last > source").select("e1", "e2", "source", "source_start")
    )


def repeated_spans(documents: DataFrame, k: int = WINDOW) -> tuple[DataFrame, int]:
    """Maximal paths of words that a document with a smaller id has too, and the salt of their text keys.

    (doc_id, text_key, first_word, last_word, source, source_word), words from 0.
    """
    copies, salt = exact_copies(documents)
    with Scratch(documents.sparkSession) as scratch:
        places = scratch(edges(documents, copies, salt, k), "edges")
        first = scratch(sources(places), "sources")
        found = places.join(first, ["e1", "e2"]).where("doc_id > source").select(
            "doc_id", "text_key", "start", "source", "source_start")
        order = Window.partitionBy("doc_id", "text_key").orderBy("start")
        before = lambda c: F.lag(c).over(order)
        step = F.col("start") - before("start")
        same = (
            (step <= 1) & (F.col("source") == before("source"))
            & (F.col("source_start") - before("source_start") == step)
        )
        paths = (
            found.withColumn("new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
            .withColumn("path", F.sum("new").over(order))
            .groupBy("doc_id", "text_key", "path", "source")
            .agg(F.min("start").alias("first_word"), (F.max("start") + (k - 1)).alias("last_word"),
                 F.min("source_start").alias("source_word"))
            .drop("path")
        )
        whole = copies.where(F.col("n_words") >= k).select(
            "doc_id", "text_key", "source", F.lit(0).alias("first_word"),
            (F.col("n_words") - 1).cast("int").alias("last_word"), F.lit(0).alias("source_word"))
        return staged(paths.unionByName(whole), "spans"), salt


def remove_spans(documents: DataFrame, spans: DataFrame, salt: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space) of every row."""
    of_doc = spans.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("first_word", "last_word")).alias("cut"))
    of_doc = of_doc.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, text, cut in rows_of([batch]):
                words = (text or b"").split()
                n = len(words)
                if cut:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, [c["first_word"] for c in cut], 1)
                    np.add.at(edge, [c["last_word"] + 1 for c in cut], -1)
                    keep = (np.cumsum(edge[:-1]) == 0).tolist()
                    words = [w for w, k in zip(words, keep, strict=True) if k]
                rows.append((doc, n, n - len(words), b" ".join(words)))
                held += len(rows[-1][3])
                if held > 8 << 20:
                    yield _kept_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _kept_batch(rows)

    texts = documents.select("doc_id", text_key(salt), raw_text().alias("text"))
    joined = texts.join(of_doc, (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return joined.select("doc_id", "text", "cut").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept binary")


def _kept_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), KEPT, strict=True)], schema=KEPT)


def dedup(documents: DataFrame, k: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept of every row."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return remove_spans(documents, *repeated_spans(documents, k))
