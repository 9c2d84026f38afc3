"""Jaccard join on word shingles: subsets for small sets, inverted lists for large ones.

Two sets of n and m shingles link when 100 * overlap >= 75 * union, so their overlap is
at least ceil(3 (n + m) / 7).

* Small (light) sets, of at most ``boundary`` shingles, enumerate all their subsets of
  the sizes such an overlap can have; two light sets that link share one.
* All sets that can link with a large one (every large set, and light ones of at least
  three quarters of the boundary) enter inverted lists by their prefix: in one fixed
  order of all shingles, the first floor(n / 4) + 1 of a set. Two sets that link share
  a shingle of both prefixes. Frequent shingles come last in that order, so that lists
  stay short; which ones are frequent changes the cost only, never the result.
* An entry's reach is the number of its set's shingles from the listed one on. At the
  first shingle two sets share in that order, the overlap is at most the smaller reach,
  so a list compares only sets whose reaches allow a link; others that link meet in an
  earlier list. A subset's entry reaches the whole set.
* The boundary is the largest size whose subsets cost no more than the list entries its
  prefix would meet, from the measured mean length of lists.

Sets that are equal are one class, named by 64 bits of hash (its node), and entries are those
of one class: n and reach are of one set, also where an id has several texts. The classes of
one id are united by links of their own. Lists are not expanded into pairs: in each, all members
are compared with a pivot, links are contracted to components, and only members whose
components still differ are compared with further pivots (1, 4, 16, 64), after which
the rest, if any, is compared pair by pair. Pairs within a component are left out as
they can't change it, and nothing else is: no link between different components is lost.

Results for odd input: a text without words (null, empty, blank) has 0 shingles, links
with nothing and is its own component; rows with one id are one document for links; rows
with a null id count in no link and get the component of the equal texts, else null;
very long texts are used whole; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.chains import mixed
from siftworks.llm.common import Scratch, raw_text, rows_of, staged
from siftworks.llm.components import components
from siftworks.llm.shingles import WordNumbers, shingle_set
from siftworks.operators.attach import fits_broadcast
from siftworks.staging import Staging

SIZE = 5
#: Frequent shingles known to all tasks (8 bytes each), and the largest light set.
FREQUENT, LARGEST_LIGHT = 100_000, 12
PIVOTS = (1, 4, 16, 64)
#: Classes that a task remembers, so as not to list their copies again.
SEEN = 1 << 16
#: Shingles of which a task looks for repeated ones at once.
MEASURED_AT_ONCE = 2_000_000
#: Cells of a set's profile: how many shingles fall into each, by their top bits.
CELL_BITS = 7


def least_overlap(n: int, m: int) -> int:
    """The smallest overlap of sets of n and m that link: 100 o >= 75 (n + m - o)."""
    return -(-3 * (n + m) // 7)


def subset_sizes(n: int, boundary: int) -> list[int]:
    """Overlaps that a set of n can need with one of at most ``boundary``."""
    return sorted({least_overlap(n, m) for m in range(1, boundary + 1) if 4 * min(n, m) >= 3 * max(n, m)})


def subset_cost(n: int, boundary: int) -> int:
    return sum(comb(n, o) for o in subset_sizes(n, boundary))


def choose_boundary(mean_list: float) -> int:
    """The largest size up to which enumerating costs no more than scanning lists."""
    boundary = 0
    for n in range(1, LARGEST_LIGHT + 1):
        if subset_cost(n, n + n // 3) > (n // 4 + 1) * (1 + mean_list):
            break
        boundary = n
    return boundary


def profile(found: np.ndarray) -> bytes:
    """Counts per cell. Two sets share at most the sum over cells of the smaller count."""
    cells = (found >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    return np.bincount(cells, minlength=1 << CELL_BITS).astype("<u4").tobytes()


def node_of(found: np.ndarray) -> int:
    """The class of a set."""
    return int.from_bytes(xxhash.xxh3_128_digest(found.tobytes())[:8], "little", signed=True)


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document (size, class of its set), and shingles several of a batch share."""
    numbers = WordNumbers()
    held: list[tuple] = []
    sets: list[np.ndarray] = []
    count = 0
    for doc, text_hash, text in rows_of(batches):
        found = shingle_set(numbers((text or b"").lower().split()), SIZE)
        held.append((doc, text_hash, len(found), node_of(found), profile(found)))
        sets.append(found)
        count += len(found)
        if count > MEASURED_AT_ONCE:
            yield _measured_batch(held, sets)
            held, sets, count = [], [], 0
    if held:
        yield _measured_batch(held, sets)


def _measured_batch(held: list[tuple], sets: list[np.ndarray]) -> pa.RecordBatch:
    shared, counts = np.unique(np.concatenate(sets), return_counts=True)
    shared, counts = shared[counts > 2], counts[counts > 2]
    docs, texts, sizes, nodes, profiles = map(list, zip(*held, strict=True))
    none, some = [None] * len(held), [None] * len(shared)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([*docs, *some], pa.int64()),
        "text_hash": pa.array([*texts, *some], pa.int64()),
        "n": pa.array([*sizes, *some], pa.int64()),
        "node": pa.array([*nodes, *some], pa.int64()),
        "profile": pa.array([*profiles, *some], pa.binary()),
        "shingle": pa.array([*none, *shared.view(np.int64).tolist()], pa.int64()),
        "docs": pa.array([*none, *counts.tolist()], pa.int64()),
    })


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), raw_text().alias("text"))


def entries(texts: DataFrame, frequent: np.ndarray, boundary: int) -> DataFrame:
    """(token, node, n, reach, own): subsets of light sets and prefix shingles of the others.

    ``own`` is the node where a token may be in very many classes (subsets and frequent
    shingles), else null.
    """
    ranks = np.argsort(frequent, kind="stable")
    ordered = frequent[ranks]
    maybe = np.zeros(1 << 22, bool)  # low bits of frequent shingles: few others need the search
    maybe[(frequent & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    picks = {(n, o): np.array(list(combinations(range(n), o)), np.int64)
             for n in range(1, boundary + 1) for o in subset_sizes(n, boundary)}

    def tokens(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, out, reach, hot = len(found), [], [], []
        if n <= boundary:
            for o in subset_sizes(n, boundary):
                out.append(mixed(mixed(found[picks[n, o]]).sum(axis=1, dtype=np.uint64) + np.uint64(o)))
                reach.append(np.full(len(out[-1]), n, np.int32))
                hot.append(np.ones(len(out[-1]), bool))
        if n > boundary or 4 * n >= 3 * (boundary + 1):
            length = n // 4 + 1
            often = maybe[(found & np.uint64((1 << 22) - 1)).astype(np.int64)]
            likely = found[often]
            at = np.minimum(np.searchsorted(ordered, likely), max(len(ordered) - 1, 0))
            often[often] = ordered[at] == likely if len(ordered) else False
            rare = found[~often][:length]
            hot.append(np.arange(length) >= len(rare))
            if len(rare) < length:
                rest = found[often][np.argsort(ranks[np.searchsorted(ordered, found[often])], kind="stable")]
                rare = np.concatenate([rare, rest[:length - len(rare)]])
            out.append(rare)
            reach.append(n - np.arange(len(rare), dtype=np.int32))
        if not out:
            return found[:0], np.zeros(0, np.int32), np.zeros(0, bool)
        if n > boundary:
            return out[0], reach[0], hot[0]  # distinct already
        every, first = np.unique(np.concatenate(out), return_index=True)
        return every, np.concatenate(reach)[first], np.concatenate(hot)[first]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, seen = WordNumbers(), set()
        for some in batches:
            held, count = [], 0
            for text, in rows_of([some]):
                found = shingle_set(numbers((text or b"").lower().split()), SIZE)
                if not len(found) or (node := node_of(found)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                held.append((node, len(found), *tokens(found)))
                count += len(held[-1][2])
                if count > 500_000:
                    yield _entry_batch(held)
                    held, count = [], 0
            if held:
                yield _entry_batch(held)

    return texts.select("text").mapInArrow(run, "token long, node long, n int, reach int, own long")


def _entry_batch(held: list[tuple]) -> pa.RecordBatch:
    sizes = [len(h[2]) for h in held]
    repeat = lambda i, kind: pa.array(np.repeat(np.array([h[i] for h in held], kind), sizes))
    nodes, cold = repeat(0, np.int64), ~np.concatenate([h[4] for h in held])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([h[2] for h in held]).view(np.int64)), nodes, repeat(1, np.int32),
         pa.array(np.concatenate([h[3] for h in held])), pa.array(nodes.to_numpy(), mask=cold)],
        names=["token", "node", "n", "reach", "own"])


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = WordNumbers()
    for some in batches:
        nodes, sets, held = [], [], 0
        for node, text in rows_of([some]):
            nodes.append(node)
            sets.append(shingle_set(numbers((text or b"").lower().split()), SIZE))
            held += sets[-1].nbytes
            if held > 8 << 20:
                yield _set_batch(nodes, sets)
                nodes, sets, held = [], [], 0
        if nodes:
            yield _set_batch(nodes, sets)


def _set_batch(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([found.tobytes() for found in sets], pa.binary()),
         pa.array([marks_of(found).tobytes() for found in sets], pa.binary())], names=["node", "found", "marks"])


def marks_of(found: np.ndarray) -> np.ndarray:
    """The top 16 bits of every shingle, ascending. Two sets share at most what their marks do."""
    return (found >> np.uint64(48)).astype("<u2")


def shared_marks(x: np.ndarray, y: np.ndarray) -> int:
    """How many marks two sets share; one that a set has several times counts as often."""
    numbered = lambda m: m.astype(np.int64) << 40 | (np.arange(len(m)) - np.searchsorted(m, m))
    x, y = numbered(x), numbered(y)
    return int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _may_link(n: str, reach: str, m: str, other: str) -> Column:
    """Whether sets of n and m that share at most the smaller reach can link: 7 o >= 3 (n + m)."""
    return 7 * F.least(reach, other).cast("long") >= 3 * (F.col(n).cast("long") + F.col(m))


def _links(shared: int, n: int, m: int) -> bool:
    return 100 * shared >= 75 * (n + m - shared)


def _able(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose profiles allow the overlap a link needs."""
    for some in batches:
        a, b = [], []
        for left, right, own, other in rows_of([some]):
            x, y = np.frombuffer(own, "<u4"), np.frombuffer(other, "<u4")
            if _links(int(np.minimum(x, y).sum()), int(x.sum()), int(y.sum())):
                a.append(left)
                b.append(right)
        yield _pairs(a, b)


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose marks allow the overlap a link needs."""
    for some in batches:
        a, b = [], []
        for left, right, own, other in rows_of([some]):
            x, y = np.frombuffer(own, "<u2"), np.frombuffer(other, "<u2")
            if _links(shared_marks(x, y), len(x), len(y)):
                a.append(left)
                b.append(right)
        yield _pairs(a, b)


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets link."""
    for some in batches:
        a, b = [], []
        for left, right, own, other in rows_of([some]):
            x, y = np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64)
            at = np.searchsorted(x, y)
            if _links(int((x[np.minimum(at, len(x) - 1)] == y).sum()), len(x), len(y)):
                a.append(left)
                b.append(right)
        yield _pairs(a, b)


class Join:
    """The classes of a table of documents, their lists, and the links found so far.

    ``unnamed``: rows with a null id take part in links too.
    """

    def __init__(self, documents: DataFrame, unnamed: bool = False) -> None:
        self.documents, self.spark = documents, documents.sparkSession
        self.part = F.lit(True) if unnamed else F.col("doc_id").isNotNull()
        measured = staged(_texts(documents).mapInArrow(
            _measure, "doc_id long, text_hash long, n long, node long, profile binary, shingle long, docs long"), "measured")
        self.rows = measured.where("n IS NOT NULL").select("doc_id", "text_hash", "n", "node")
        self.linked = self.rows.where((F.col("n") > 0) & self.part)
        profiles = measured.where((F.col("n") > 0) & self.part).select("node", "profile")
        shared = measured.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("docs").alias("docs"))
        # A bounded list in falling frequency; the order of the rest is by hash.
        top = shared.orderBy(F.desc("docs"), "shingle").limit(FREQUENT).collect()
        total = self.rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        mean = sum(r["docs"] ** 2 for r in top) / max(total, 1)
        self.boundary = choose_boundary(mean)
        self.frequent = np.array([r["shingle"] for r in top][::-1], np.int64).view(np.uint64)
        # The first place stands for the class where its set is read again.
        places = self.linked.groupBy("node", F.coalesce("doc_id", "text_hash").alias("at"), "text_hash").agg(
            F.count(F.lit(1)).alias("copies"))
        self.classes = staged(places.groupBy("node").agg(F.min(F.struct("at", "text_hash", "copies")).alias("first"))
                              .select("node", "first.*"), "classes")
        self.profiles = staged(profiles.groupBy("node").agg(F.first("profile").alias("profile")), "profiles")

    def lists(self) -> DataFrame:
        """(token, node, n, reach) of tokens that several classes have."""
        with Scratch(self.spark) as scratch:
            every = entries(_texts(self.documents.where(self.part)), self.frequent, self.boundary)
            # One shuffle serves both steps. Tokens that may be hot are spread by their class
            # and stay; of these, lists of one class go with the distinct lists.
            of_token = Window.partitionBy("token", "own")
            ends = every.withColumns({"a": F.min("node").over(of_token), "b": F.max("node").over(of_token)})
            shared = ends.where("own IS NOT NULL OR a < b").groupBy("token", "own", "node").agg(
                F.max("n").alias("n"), F.max("reach").alias("reach"))
            return self._distinct_lists(scratch(shared.drop("own"), "lists"))

    def _distinct_lists(self, lists: DataFrame) -> DataFrame:
        """One of the lists that have the same members (128 bits of sums), of two or more.

        It is the first in the order of shingles, where all members reach furthest. Entries
        that don't reach far enough for the smallest set of their list go.
        """
        member = lambda seed: F.sum(F.xxhash64(F.lit(seed), "node", "n").cast("decimal(20,0)"))
        marks = lists.groupBy("token").agg(
            F.count(F.lit(1)).alias("members"), member(1).alias("s"), member(2).alias("t"),
            F.sum("reach").alias("reach"), F.min("n").alias("least"))
        kept = marks.where("members > 1").groupBy("members", "s", "t").agg(
            F.max(F.struct("reach", "token", "least")).alias("first"))
        with Scratch(self.spark) as scratch:
            kept = scratch(kept.select("first.token", "first.least"), "kept")
            return staged(lists.join(kept, "token").where("7L * reach >= 3L * (n + least)").drop("least"), "lists")

    def _narrow(self, staging: Staging, frame: DataFrame, name: str) -> DataFrame:
        """A written table, to be broadcast where its written size allows."""
        written = staging.write(frame, name)
        return F.broadcast(written.frame) if fits_broadcast(written) else written.frame

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: first by the bounds of profiles and marks, then by their sets.

        Profiles, texts and sets are narrowed to the classes in question before they are joined.
        """
        both = lambda pairs, table, value: (
            pairs.join(table.select(F.col("node").alias("b"), F.col(value).alias("other")), "b")
            .join(table.select(F.col("node").alias("a"), F.col(value).alias("own")), "a")
            .select("a", "b", "own", "other"))
        ends_of = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        staging = Staging(self.spark)
        with Scratch(self.spark) as scratch:
            pairs = scratch(pairs.distinct(), "pairs")
            asked = self._narrow(staging, ends_of(pairs), "asked")
            profiles = scratch(self.profiles.join(asked, "node", "left_semi"), "profiles")
            able = scratch(both(pairs, profiles, "profile").mapInArrow(_able, "a long, b long").distinct(), "able")
            ends = scratch(ends_of(able).join(self.classes, "node"), "ends")
            several = not ends.where("copies > 1").isEmpty()
            texts = _texts(self.documents).withColumn("at", F.coalesce("doc_id", "text_hash")).join(
                self._narrow(staging, ends, "places"), ["at", "text_hash"]).select("node", "at", "text_hash", "copies", "text")
            if several:
                # Of rows equal in id and text, one; other rows are not sorted for it.
                texts = scratch(texts, "texts")
                texts = texts.where("copies = 1").union(
                    texts.where("copies > 1").dropDuplicates(["at", "text_hash", "node"]))
            sets = scratch(texts.select("node", "text").mapInArrow(_sets, "node long, found binary, marks binary"), "sets")
            near = scratch(both(able, sets, "marks").mapInArrow(_near, "a long, b long"), "near")
            close = sets.join(self._narrow(staging, ends_of(near), "close"), "node", "left_semi")
            found = staged(both(near, close, "found").mapInArrow(_verify, "a long, b long"), "found")
        staging.drop()
        return found

    def id_links(self) -> DataFrame:
        """(a, b): a class of every id that has several, and each other one."""
        several = self.linked.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
        with Scratch(self.spark) as scratch:
            several = scratch(several.select("doc_id", "a"), "several")
            return staged(self.linked.join(several, "doc_id").where("a <> node").select(
                "a", F.col("node").alias("b")).distinct(), "id_links")

    def labels(self, given: DataFrame | None = None) -> DataFrame:
        """(node, label) of all nodes with a link, those ``given`` (a, b) among them."""
        lists = self.lists()
        with Scratch(self.spark) as scratch:
            label = None
            for pivots in (*PIVOTS, None):
                first = scratch(self._pivots(lists, pivots), "pivots")
                pairs = lists.join(first, "token").where(_may_link("n", "reach", "pn", "pr"))
                pairs = pairs.where("p <> node" if pivots else "p < node")
                if label is not None:
                    pairs = pairs.where("label <> pl")
                found = self.verify(
                    pairs.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")))
                if label is None and given is not None:
                    found = found.union(given)
                if label is not None:
                    # Earlier links count as the stars they were contracted to.
                    found = found.union(label.where("node <> label").select("label", "node"))
                label = components(found)
                if pivots is None:
                    break
                # Pivots are done; what is left matters where components still differ.
                done = first.select("token", F.col("p").alias("node"))
                rest = lists.drop("label").join(done, ["token", "node"], "left_anti")
                rest = scratch(rest.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")), "rest")
                open_ = rest.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
                open_ = scratch(open_.select("token"), "unsettled")
                lists = self._distinct_lists(scratch(rest.join(open_, "token"), "open"))
                if lists.isEmpty():
                    break
            return label

    @staticmethod
    def _pivots(lists: DataFrame, pivots: int | None) -> DataFrame:
        """token, p, pn, pr (and pl): the members of each list with the lowest hashes, or all."""
        if pivots is not None:
            # The rank limit is applied before the shuffle too.
            order = Window.partitionBy("token").orderBy(F.xxhash64(F.lit(str(pivots)), "node"), "node")
            lists = lists.withColumn("r", F.row_number().over(order)).where(F.col("r") <= pivots)
        label = [F.col("label").alias("pl")] if "label" in lists.columns else []
        return lists.select("token", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("reach").alias("pr"), *label)

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row."""
        label = self.labels(self.id_links())
        named = self.classes.select("node").join(label, "node", "left").select(
            "node", F.coalesce("label", "node").alias("label"))
        with Scratch(self.spark) as scratch:
            ids = scratch(self.linked.groupBy("node").agg(F.min("doc_id").alias("least")).join(named, "node"), "ids")
            least = scratch(ids.groupBy("label").agg(F.min("least").alias("component_id")), "least")
            # Written first: the join then reads two plain shuffles, of which hot parts can be split.
            named = staged(ids.join(least, "label").select(F.col("node").alias("_node"), "component_id"), "components")
        return self.rows.join(named, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))

    def groups(self) -> DataFrame:
        """doc_id, text_hash, group of every row with words: linked sets share a group, whatever their ids."""
        label = self.labels()
        return self.linked.join(label, "node", "left").select(
            "doc_id", "text_hash", F.coalesce("label", "node").alias("group"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every row."""
    return Join(documents).result()


def text_groups(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, group of every row with words; rows of one id are not united, those without one take part."""
    return Join(documents, unnamed=True).groups()
