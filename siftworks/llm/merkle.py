"""Merkle manifest of a dataset: one root digest, and for every row the proof that it is in.

A row's leaf is the digest of its fields, each ``-`` if null, else its UTF-8 length, ``:``
and its value. Leaves of a tree (one per source) lie in order; every ``FANOUT`` consecutive
nodes become the digest of theirs, the last run being as short as it may be, until one node
remains. The roots of all trees, in order of their sources, make the last tree in the same way.

The nodes of a tree are ranked through one range shuffle of narrow rows and a count per
(partition, tree). Written in base ``FANOUT``, the lowest ``DIGITS`` digits of a rank are
columns; grouping them away one after another nests the children of each node as an array
of structs, and a block of ``FANOUT ** DIGITS`` neighbours ends as one row. One shuffle by
(tree, block) serves all these groupings. Blocks are nodes again, ranked by their number, so
a few rounds reach the roots however large the tree. On the way down, a block's nested row
is transformed into (node, path to the root) and exploded: no node is joined to a sibling.
The only joins bring a block its own path, one row to one row.

Results for odd input: null fields are ``-``; leaves are ordered by id, null first, then by
digest; equal rows are leaves of their own with equal digests, and which of them has which
place does not show in any result but their proofs; an empty table has no root and gives no
rows; texts of any length are digested whole, where they are read; columns that are no field
of the leaf are neither digested nor carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.functions.naming import col
from siftworks.llm.common import Scratch, staged
from siftworks.operators.attach import attach
from siftworks.staging import Staging

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
#: Digits of a rank that one block groups away; a block holds FANOUT ** DIGITS nodes.
DIGITS = 5
WIDTH = FANOUT ** DIGITS

_PATH = "array<struct<left: string, right: string>>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row's fields, which no other division into fields can give."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, side: F.sha2(F.concat(side["left"], node, side["right"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests of a path, from leaf to root and left to right, as one text."""
    return F.array_join(F.transform(path, lambda side: F.concat(side["left"], side["right"])), "")


def _ranked(nodes: DataFrame, tree: str, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """Add ``rank`` from 0 within the tree, and ``size``, the tree's number of nodes."""
    keys = [tree, *order]
    placed = scratch(
        nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()), "placed",
    ).withColumn("_part", F.shiftrightunsigned("_at", 33))
    runs = placed.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_sw_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(tree)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        tree, "_part", "_sw_n", "_first", F.sum("_sw_n").over(whole).alias("size"),
        F.coalesce(F.sum("_sw_n").over(earlier), F.lit(0)).alias("_before"),
    )
    offsets = Staging(nodes.sparkSession).write(runs, "runs")
    found = attach(placed, offsets.frame, offsets, [tree, "_part"], spread=["_at"])
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    return found.withColumn("rank", rank).drop("_part", "_sw_n", "_first", "_before", "_at")


def _roll_up(nodes: DataFrame, tree: str, kept: Sequence[str]) -> DataFrame:
    """One row per block: tree, block, size in blocks, digest, and the nested nodes."""
    digit = [f"_d{k}" for k in range(DIGITS)]
    rank = F.col("rank")
    rows = nodes.select(
        tree, F.floor(rank / WIDTH).alias("block"), "size",
        *[(F.floor(rank / FANOUT ** k) % FANOUT).cast("int").alias(d) for k, d in enumerate(digit)],
        F.struct("digest", *kept).alias("node"),
    ).repartition(tree, "block")
    for k, d in enumerate(digit):
        above = digit[k + 1:]
        kids = F.sort_array(F.collect_list(F.struct(F.col(d).alias("i"), "node")))["node"]
        rows = rows.groupBy(tree, "block", "size", *above).agg(kids.alias("kids"))
        digest = F.when(
            F.col("size") > FANOUT ** k, F.sha2(F.array_join(F.col("kids.digest"), ""), 256)
        ).otherwise(F.col("kids")[0]["digest"])
        rows = rows.select(tree, "block", "size", *above, F.struct(digest.alias("digest"), "kids").alias("node"))
    return rows.select(
        tree, "block", "size", F.ceil(F.col("size") / WIDTH).alias("blocks"), "node.digest",
        F.col("node.kids").alias("kids"))


def _rounds(nodes: DataFrame, tree: str, kept: Sequence[str]) -> list[DataFrame]:
    """The blocks of every round, until each tree is one block."""
    rounds = [staged(_roll_up(nodes, tree, kept), "blocks")]
    while not (rest := rounds[-1].where("blocks > 1")).isEmpty():
        nodes = rest.select(tree, F.col("block").alias("rank"), F.col("blocks").alias("size"), "digest")
        rounds.append(staged(_roll_up(nodes.withColumn("number", F.col("rank")), tree, ["number"]), "blocks"))
    return rounds


def _roots(rounds: Sequence[DataFrame], tree: str) -> DataFrame:
    """Tree and digest of its root; every tree ends in one round."""
    ended = [blocks.where("blocks = 1").select(tree, "digest") for blocks in rounds]
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    return found


def _opened(parent: Column, size: Column, k: int) -> Column:
    """The nodes below one, each with its own siblings before the path of the parent."""
    digests = parent["kids"]["digest"]

    def below(kid: Column, i: Column) -> Column:
        sides = F.struct(
            F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
            F.array_join(F.slice(digests, i + 2, F.lit(FANOUT)), "").alias("right"),
        )
        # A tree that is one node already at this height has no run here.
        longer = F.when(size > FANOUT ** k, F.concat(F.array(sides), parent["path"]))
        node = kid["kids"].alias("kids") if k else kid.alias("node")
        return F.struct(node, F.coalesce(longer, parent["path"]).alias("path"))

    return F.transform(parent["kids"], below)


def _step(size: Column, k: int):
    return lambda parent: _opened(parent, size, k)


def _nodes_with_paths(size: Column, kids: Column, path: Column) -> Column:
    """The lowest nodes of a block, each with its path: array of (node, path)."""
    opened = F.array(F.struct(kids.alias("kids"), path.alias("path")))
    for k in reversed(range(DIGITS)):
        opened = F.flatten(F.transform(opened, _step(size, k)))
    return opened


def _descend(blocks: DataFrame, heads: DataFrame, on: Sequence[tuple[str, str]], carried: Sequence[str]) -> DataFrame:
    """Blocks with the path and carried columns of their heads, one row to one row, exploded."""
    renamed = heads.select(
        *[F.col(theirs).alias(f"_on_{theirs}") for _, theirs in on], F.col("path").alias("_path"), *carried)
    match = None
    for ours, theirs in on:
        equal = F.col(ours).eqNullSafe(F.col(f"_on_{theirs}"))
        match = equal if match is None else match & equal
    joined = blocks.join(renamed, match)
    found = joined.select(
        blocks.columns[0], *carried,
        F.explode(_nodes_with_paths(F.col("size"), F.col("kids"), F.col("_path"))).alias("found"),
    )
    return found.select(blocks.columns[0], *carried, "found.node.*", "found.path")


def _unroll(rounds: Sequence[DataFrame], tree: str, ends: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The nodes of the first round with their whole paths; ``ends`` has one row per tree."""
    above = None
    for n, blocks in reversed(list(enumerate(rounds))):
        found = _descend(blocks.where("blocks = 1"), ends, [(tree, tree)], carried)
        if above is not None:
            inner = _descend(blocks.where("blocks > 1"), above, [(tree, tree), ("block", "number")], carried)
            found = found.unionByName(inner)
        above = staged(found, "paths") if n else found
    return above


def manifest(
    documents: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "source", order: str = "doc_id",
    checked: Column | None = None,
) -> DataFrame:
    """Every row's id, source, leaf, path, subroot and root.

    ``checked`` is a digest computed from the row, such as the leaf of a copy that may have been
    tampered with; it is carried along as ``checked``, so that it can be folded up the path.
    """
    digests = documents.select(
        col(tree).alias("source"), col(order).alias("id"),
        leaf_digest([col(f) for f in fields]).alias("digest"),
        (F.lit(None).cast("string") if checked is None else checked).alias("checked"),
        # Lets a range bound fall between equal rows.
        F.monotonically_increasing_id().alias("_salt"),
    )
    with Scratch(documents.sparkSession) as scratch:
        leaves = _ranked(scratch(digests, "leaves"), "source", ["id", "digest", "_salt"], scratch)
        rounds = _rounds(leaves, "source", ["id", "checked"])
        subroots = _roots(rounds, "source").select(F.lit(0).alias("all"), "source", "digest")
        crowns = _rounds(_ranked(subroots, "all", ["source"], scratch), "all", ["source"])
    top = _roots(crowns, "all").select("all", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    ends = _unroll(crowns, "all", top, ["root"]).withColumnRenamed("digest", "subroot")
    found = _unroll(rounds, "source", staged(ends, "ends"), ["root", "subroot"])
    return found.select(
        F.col("id").alias(order), F.col("source").alias(tree), F.col("digest").alias("leaf"),
        "checked", "path", "subroot", "root")
