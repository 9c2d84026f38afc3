"""Lightest repair of conversations whose rows were lost, emptied, cut, doubled or mislabelled.

A conversation should read: optionally system, then user and assistant in turns, or nothing.
Edits of its rows in order spell an *audit*: Keep (cost 0), Rerole to user or assistant (2),
Delete (3), Insert an empty user or assistant row (2); a truncated row that stays costs 1
more, and blank or duplicate rows have to go. Of the cheapest repairs, the one with the least
audit is taken. Each repair is a derivation: items are (rows consumed, role state), edits are
weighted deductions from item to item, and an agenda pops items in order of (cost, audit)
until the goal item is final. Every deduction adds to the cost and to the end of the audit,
so none can make a lighter item, and of two values of one item the lighter stays lighter
(at equal cost neither audit begins with the other): the first value popped is the least.

Rows are dealt out by one range shuffle in (conversation, turn) order, so a conversation of
any share of the rows is spread over many tasks. A conversation within one block of one task
is finished there. Others leave a block for every ``BLOCK`` rows, with the lightest audits
between any two states; blocks are then nodes of the same agenda, one conversation in one
task, in memory of some sixteen characters a row. The digest of a conversation that fills
several blocks is read in order by one task, as a digest has to be; the blocks' texts are
made in parallel before.

Results for odd input: null roles and texts are one space; rows of one turn are in order of
role and text (bytes), a null turn comes first; equal rows are kept as rows of their own, of
which all but the first are duplicates; equal role and text are found by 128 bits of hash
and an equal turn; a role that is empty or begins with another letter cannot be kept; a null
conversation id is a conversation; a conversation without rows needs no repair; very long
texts close a block early; an empty table gives an empty one. Columns other than the four
are not carried, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.naming import col
from siftworks.llm.common import batch, rows_of, staged
from siftworks.operators.attach import attach
from siftworks.staging import Staging

#: Rows and bytes of one block.
BLOCK, BLOCK_BYTES = 256, 4 << 20
#: Blocks whose lightest audits are joined at once.
FANIN = 32
#: Bytes of role and text that range bounds may use to divide one turn.
PREFIX = 64

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
START, SYSTEM, USER, ASSISTANT, GOAL = range(5)
#: From a role state, the state after a row with this initial; nothing else is legal.
AFTER = {
    (START, b"s"): SYSTEM, (START, b"u"): USER, (SYSTEM, b"u"): USER, (ASSISTANT, b"u"): USER,
    (USER, b"a"): ASSISTANT,
}
LEGAL_PAIRS = {b"su", b"ua", b"au"}

#: One or more equal rows as the agenda sees them: initial, truncated, or a number to delete.
Row = tuple[bytes, bool, int]
Value = tuple[int, str]
Deduction = tuple[int, str, int, int]


def lightest(deductions: Callable[[int, int], Iterable[Deduction]], start: int, goal: tuple[int, int] | None) -> dict:
    """Final (cost, audit) of the items (place, state), up to the goal if there is one.

    ``deductions(place, state)`` gives (cost, edits, place, state) for all that follows.
    """
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: dict[tuple[int, int], Value] = {}
    while agenda:
        cost, audit, place, state = heapq.heappop(agenda)
        if (place, state) in final:
            continue
        final[place, state] = cost, audit
        if (place, state) == goal:
            break
        for more, edits, to, then in deductions(place, state):
            if (to, then) not in final:
                heapq.heappush(agenda, (cost + more, audit + edits, to, then))
    return final


def _edits(rows: Sequence[Row], ends: bool) -> Callable[[int, int], Iterator[Deduction]]:
    """The edits possible at each row; ``ends`` if nothing follows the last."""
    def deductions(place: int, state: int) -> Iterator[Deduction]:
        if ends and place == len(rows) and state in (START, ASSISTANT):
            yield 0, "", place, GOAL
        for initial in (b"u", b"a"):
            if (state, initial) in AFTER:
                yield INSERT, "I", place, AFTER[state, initial]
        if place < len(rows):
            initial, truncated, unwanted = rows[place]
            if unwanted:
                yield DELETE * unwanted, "D" * unwanted, place + 1, state
                return
            yield DELETE, "D", place + 1, state
            if (state, initial) in AFTER:
                yield KEEP + TRUNCATED * truncated, "K", place + 1, AFTER[state, initial]
            for role in (b"u", b"a"):
                if (state, role) in AFTER:
                    yield REROLE + TRUNCATED * truncated, "R", place + 1, AFTER[state, role]

    return deductions


@functools.lru_cache(maxsize=50_000)
def repair_whole(rows: tuple[Row, ...]) -> Value:
    """Cost and audit of a conversation; many have the same initials and faults."""
    goal = len(rows), GOAL
    return lightest(_edits(rows, True), START, goal)[goal]


def repair_between(rows: Sequence[Row]) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) of a block, for every state before and after it."""
    found = []
    for before in range(GOAL):
        final = lightest(_edits(rows, False), before, None)
        found += [(before, q, *final[len(rows), q]) for q in range(GOAL) if (len(rows), q) in final]
    return found


def _hops(blocks: Sequence[list], ends: bool) -> Callable[[int, int], Iterator[Deduction]]:
    def deductions(place: int, state: int) -> Iterator[Deduction]:
        if place < len(blocks):
            for before, after, cost, audit in blocks[place]:
                if before == state:
                    yield cost, audit, place + 1, after
        elif ends and state in (START, ASSISTANT):
            yield 0, "", place, GOAL

    return deductions


def join_blocks(blocks: list[list]) -> Value:
    """Cost and audit of a conversation from the lightest audits of its blocks."""
    while len(blocks) > FANIN:
        joined = []
        for at in range(0, len(blocks), FANIN):
            some, pairs = blocks[at:at + FANIN], []
            for before in range(GOAL):
                final = lightest(_hops(some, False), before, None)
                pairs += [(before, q, *final[len(some), q]) for q in range(GOAL) if (len(some), q) in final]
            joined.append(pairs)
        blocks = joined
    goal = len(blocks), GOAL
    return lightest(_hops(blocks, True), START, goal)[goal]


def damage(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """conv_id, turn, role, text and copies: rows as a lossy transport would leave them.

    A digest of id and turn decides: dropped (no copies), emptied, without sentence ends,
    doubled, or said by the user. Nulls are one space, but for id and turn as such.
    """
    space = F.lit(" ")
    conv, turn = col(conv_col).cast("long"), col(turn_col).cast("long")
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(col(role_col), space), F.coalesce(col(text_col), space)
    return conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _with_first_turns(rows: DataFrame) -> DataFrame:
    """Add ``first``: does the row's turn hold the first such role and text of its conversation?

    Rows equal in all become one with their copies, so that a mass of them is one row.
    """
    same = [F.xxhash64("role", "text").alias("_k1"), F.xxhash64(F.lit(7), "text", "role").alias("_k2")]
    keyed = rows.select("*", *same)
    seen = keyed.where("copies > 0").groupBy("conv_id", "_k1", "_k2").agg(
        F.count(F.lit(1)).alias("_sw_n"), F.count("turn").alias("_dated"), F.min("turn").alias("_low")
    ).where("_sw_n > 1")
    repeated = Staging(rows.sparkSession).write(seen, "repeated")
    first = F.when(F.col("_dated") == F.col("_sw_n"), F.col("_low")).alias("_turn")
    lookup = repeated.frame.select("conv_id", "_k1", "_k2", "_sw_n", first)
    marked = attach(keyed, lookup, repeated, ["conv_id", "_k1", "_k2"], spread=["turn", "_k1"])
    several = F.col("_sw_n").isNotNull() & (F.col("copies") > 0)
    marked = marked.withColumn("first", ~several | F.col("turn").eqNullSafe(F.col("_turn")))
    columns = ["conv_id", "turn", "role", "text", "copies", "first"]
    merged = marked.where(several).groupBy("conv_id", "turn", "role", "text", "first").agg(
        F.sum("copies").alias("copies"))
    return marked.where(~several).select(*columns).unionByName(merged)


class _Block:
    """Consecutive rows of one conversation."""

    def __init__(self, conv: int | None) -> None:
        self.conv = conv
        self.size = 0
        self.rows: list[tuple[bytes, bytes, int]] = []
        self.seen: list[Row] = []
        self.low = self.high = self.last_turn = None
        self.first_turn: int | None = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_initial = self.last_initial = None

    def add(self, turn: int | None, role: bytes, text: bytes, copies: int, first: bool) -> None:
        if not copies:
            return
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL_PAIRS
        self.illegal += copies - 1
        self.first_initial = initial if self.first_initial is None else self.first_initial
        self.last_initial = initial
        self.size += len(text)
        tail = text.rstrip()
        if not tail:
            self.blank += copies
            self._append(role, text, initial, False, copies)
            return
        if first:
            cut = tail[-1:] not in (b".", b"!", b"?")
            self.truncated += cut
            self._append(role, text, initial, cut, 0)
        unwanted = copies - first
        if unwanted:
            self.duplicate += unwanted
            self._append(role, text, initial, False, unwanted)

    def _append(self, role: bytes, text: bytes, initial: bytes, cut: bool, unwanted: int) -> None:
        self.rows.append((role, text, unwanted))
        self.seen.append((b"" if unwanted else initial, cut, unwanted))

    @property
    def full(self) -> bool:
        return len(self.rows) >= BLOCK or self.size >= BLOCK_BYTES


def repaired(rows: Iterable[tuple[bytes, bytes, int]], audit: str, written: int, system: bool) -> list[tuple[bytes, bytes]]:
    """Role and text of the rows an audit leaves, ``written`` rows into the conversation.

    An inserted or reroled row's role follows from how many rows stand before it.
    """
    out, left = [], iter(rows)
    at = 0
    while at < len(audit):
        edit = audit[at]
        at += 1
        if edit == "I":
            role, text = None, b""
        else:
            role, text, unwanted = next(left)
            if edit == "D":
                at += max(unwanted, 1) - 1
                continue
        if edit != "K":
            role = b"user" if (written + len(out) - system) % 2 == 0 else b"assistant"
        out.append((role, text))
    return out


def _starts_with_system(audit: str) -> bool:
    """User and assistant rows come in pairs, so an odd number of rows begins with system."""
    return (len(audit) - audit.count("D")) % 2 == 1


def _lines(pairs: Iterable[tuple[bytes, bytes]]) -> bytes:
    return b"\n".join([role + b":" + text for role, text in pairs])


_PAIR = pa.struct([("role", pa.binary()), ("text", pa.binary())])
_ITEM = pa.struct([("role", pa.binary()), ("text", pa.binary()), ("unwanted", pa.int64())])
_HOP = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
BLOCKS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("whole", pa.bool_()),
    *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("digest", pa.string()),
    ("lines", pa.list_(_PAIR)), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("first_initial", pa.binary()), ("last_initial", pa.binary()), ("n_rows", pa.int64()),
    ("hops", pa.list_(_HOP)), ("items", pa.list_(_ITEM)),
])
_BLOCKS_DDL = (
    "conv_id long, part int, seq long, whole boolean, gaps long, blank long, duplicate long, truncated long,"
    " illegal long, cost long, audit string, digest string, lines array<struct<role: binary, text: binary>>,"
    " low long, high long, turns long, first_turn long, last_turn long, first_initial binary, last_initial binary,"
    " n_rows long, hops array<struct<before: int, after: int, cost: long, audit: string>>,"
    " items array<struct<role: binary, text: binary, unwanted: long>>"
)


def _gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def _finished(block: _Block, part: int, with_lines: bool) -> tuple:
    cost, audit = repair_whole(tuple(block.seen))
    pairs = repaired(block.rows, audit, 0, _starts_with_system(audit))
    return (
        block.conv, part, 0, True, _gaps(block.low, block.high, block.turns), block.blank, block.duplicate,
        block.truncated, block.illegal, cost, audit, hashlib.sha256(_lines(pairs)).hexdigest(),
        [{"role": r, "text": t} for r, t in pairs] if with_lines else None, *[None] * 8, None, None,
    )


def _unfinished(block: _Block, part: int, seq: int) -> tuple:
    hops = [dict(zip(("before", "after", "cost", "audit"), h, strict=True)) for h in repair_between(block.seen)]
    items = [{"role": r, "text": t, "unwanted": n} for r, t, n in block.rows]
    n_rows = sum(max(n, 1) for _, _, n in block.rows)
    return (
        block.conv, part, seq, False, None, block.blank, block.duplicate, block.truncated, block.illegal, None,
        None, None, None, block.low, block.high, block.turns, block.first_turn, block.last_turn,
        block.first_initial, block.last_initial, n_rows, hops, items,
    )


def _blocks(rows: DataFrame, with_lines: bool) -> DataFrame:
    """Finished conversations, and blocks of those that a task cannot see the ends of."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, held = TaskContext.get().partitionId(), [], 0
        block: _Block | None = None
        seq, opening = 0, True  # of the conversation being read; is it the task's first?
        for conv, *row in rows_of(batches):
            if block is None:
                block = _Block(conv)
            elif conv != block.conv:
                finished = seq == 0 and not opening
                out.append(_finished(block, part, with_lines) if finished else _unfinished(block, part, seq))
                held += block.size
                block, seq, opening = _Block(conv), 0, False
            elif block.full:
                out.append(_unfinished(block, part, seq))
                held += block.size
                block, seq = _Block(conv), seq + 1
            block.add(*row)
            if len(out) >= 2_000 or held > 4 * BLOCK_BYTES:
                yield batch(BLOCKS, list(zip(*out, strict=True)))
                out, held = [], 0
        if block is not None:
            out.append(_unfinished(block, part, seq))
        if out:
            yield batch(BLOCKS, list(zip(*out, strict=True)))

    # Role and text in one value, in the same order as one after the other.
    place = F.concat("role", F.lit("\0"), "text")
    spread = rows.withColumn("_place", F.substring(place, 1, PREFIX))
    dealt = spread.repartitionByRange("conv_id", "turn", "_place").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select(
        "conv_id", "turn", F.col("role").cast("binary"), F.col("text").cast("binary"), "copies", "first",
    ).mapInArrow(cut, _BLOCKS_DDL)


_PATHS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("piece", pa.string()),
    ("written", pa.int64()), ("system", pa.bool_()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()),
])
_PATHS_DDL = (
    "conv_id long, part int, seq long, piece string, written long, system boolean, gaps long, blank long,"
    " duplicate long, truncated long, illegal long, cost long, audit string"
)
_NARROW = [
    "conv_id", "part", "seq", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns",
    "first_turn", "last_turn", "first_initial", "last_initial", "n_rows", "hops",
]


def _solved(blocks: list[dict]) -> Iterator[tuple]:
    """A row for the conversation and one per block with its piece of the audit."""
    sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    low = high = last_turn = last_initial = None
    for b in blocks:
        for name in sums:
            sums[name] += b[name]
        if b["low"] is not None:
            sums["turns"] -= b["first_turn"] == last_turn
            low, high, last_turn = b["low"] if low is None else low, b["high"], b["last_turn"]
        if b["first_initial"] is not None:
            if last_initial is not None:
                sums["illegal"] += last_initial + b["first_initial"] not in LEGAL_PAIRS
            last_initial = b["last_initial"]
    cost, audit = join_blocks([[(h["before"], h["after"], h["cost"], h["audit"]) for h in b["hops"]] for b in blocks])
    system, at, written = _starts_with_system(audit), 0, 0
    conv = blocks[0]["conv_id"]
    yield (conv, None, None, None, None, None, _gaps(low, high, sums["turns"]), sums["blank"], sums["duplicate"],
           sums["truncated"], sums["illegal"], cost, audit)
    for n, b in enumerate(blocks):
        end, rows = at, b["n_rows"]
        while rows:
            rows -= audit[end] != "I"
            end += 1
        piece = audit[at:] if n == len(blocks) - 1 else audit[at:end]
        yield conv, b["part"], b["seq"], piece, written, system, *[None] * 7
        at, written = end, written + len(piece) - piece.count("D")


def _paths(blocks: DataFrame) -> DataFrame:
    """The lightest way through the blocks of each conversation."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (dict(zip(_NARROW, row, strict=True)) for row in rows_of(batches))
        for _, group in groupby(rows, key=lambda b: b["conv_id"]):
            yield batch(_PATHS, list(zip(*_solved(list(group)), strict=True)))

    return blocks.select(*_NARROW).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(
        solve, _PATHS_DDL)


_CHUNKS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("written", pa.int64()), ("lines", pa.list_(_PAIR)),
])
_CHUNKS_DDL = "conv_id long, part int, seq long, written long, lines array<struct<role: binary, text: binary>>"


def _chunks(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The repaired rows of every block."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, part, seq, items, piece, written, system in rows_of(batches):
            rows = [(i["role"], i["text"], i["unwanted"]) for i in items]
            pairs = [{"role": r, "text": t} for r, t in repaired(rows, piece, written, system)]
            yield batch(_CHUNKS, [[conv], [part], [seq], [written], [pairs]])

    pieces = paths.where("part IS NOT NULL").select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("seq").alias("_seq"),
        "piece", "written", "system")
    match = (
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("seq") == F.col("_seq"))
    )
    return blocks.select("conv_id", "part", "seq", "items").join(pieces, match).select(
        "conv_id", "part", "seq", "items", "piece", "written", "system").mapInArrow(write, _CHUNKS_DDL)


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("digest", pa.string())])


def _digests(chunks: DataFrame) -> DataFrame:
    """Digest of each conversation, block after block."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((conv, lines) for conv, _, _, lines in rows_of(batches))
        for conv, group in groupby(rows, key=lambda row: row[0]):
            found, begun = hashlib.sha256(), False
            for _, lines in group:
                if lines:
                    found.update((b"\n" if begun else b"") + _lines([(p["role"], p["text"]) for p in lines]))
                    begun = True
            yield batch(_DIGESTS, [[conv], [found.hexdigest()]])

    return chunks.select("conv_id", "part", "seq", "lines").repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "seq").mapInArrow(digest, "conv_id long, digest string")


def _checked(rows: DataFrame) -> DataFrame:
    columns: list[Column] = [F.col(c) for c in ("conv_id", "turn", "role", "text", "copies")]
    return _with_first_turns(rows.select(*columns))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit and digest of the repaired rows.

    ``rows`` has conv_id, turn, role, text and copies; a row of no copies only names its conversation.
    """
    blocks = staged(_blocks(_checked(rows), False), "blocks")
    columns = ["conv_id", *_COUNTS, "audit", "digest"]
    open_ = blocks.where("NOT whole")
    paths = staged(_paths(open_), "paths")
    digests = _digests(_chunks(open_, paths)).select(F.col("conv_id").alias("_conv"), "digest")
    solved = paths.where("part IS NULL").drop("digest").join(
        digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*columns)
    return blocks.where("whole").select(*columns).unionByName(solved)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position from 0, role, text."""
    blocks = staged(_blocks(_checked(rows), True), "blocks")
    open_ = blocks.where("NOT whole")
    chunks = _chunks(open_, staged(_paths(open_), "paths")).select("conv_id", "written", "lines")
    whole = blocks.where("whole").select("conv_id", F.lit(0).cast("long").alias("written"), "lines")
    return whole.unionByName(chunks).select("conv_id", "written", F.posexplode("lines").alias("at", "line")).select(
        "conv_id", (F.col("written") + F.col("at")).alias("position"),
        F.col("line.role").cast("string").alias("role"), F.col("line.text").cast("string").alias("text"))
