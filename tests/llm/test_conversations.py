"""Conversation repair against enumeration of all edits and plain relaxation."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from siftworks.llm import conversations
from siftworks.llm.queries import op12_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SHAPE = re.compile("(s?(ua)+)?")
SPACE = " \t\n\r\x0b\x0c"


def enumerate_repairs(rows):
    """All repairs of few rows with at most two rows inserted at a place: least (cost, audit) and its lines."""
    inserted = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None
    options = [["D"] if r[2] in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for r in rows]
    for edits in itertools.product(*options):
        for gaps in itertools.product(inserted, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for place in range(len(rows) + 1):
                for role in gaps[place]:
                    cost, audit = cost + 2, audit + "I"
                    out.append((role, ""))
                if place < len(rows):
                    edit, (role, text, fault) = edits[place], rows[place]
                    audit += edit[0]
                    cost += {"K": 0, "R": 2, "D": 3}[edit[0]] + (edit != "D" and fault == "truncated")
                    if edit != "D":
                        out.append(({"K": role, "Ru": "user", "Ra": "assistant"}[edit], text))
            initials = [r[:1] for r, _ in out]
            if all(initials) and SHAPE.fullmatch("".join(initials)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, out
    return best


def relax(rows):
    """The same by relaxing (place, state) until nothing changes."""
    after = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {(0, "0"): (0, "", ())}
    changed = True
    while changed:
        changed = False
        for (place, state), (cost, audit, out) in list(best.items()):
            moves = [(2, "I", place, r, (r, "")) for r in ("user", "assistant")]
            if place < len(rows):
                role, text, fault = rows[place]
                moves.append((3, "D", place + 1, None, None))
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    moves.append((more, "K", place + 1, role, (role, text)))
                    moves += [(2 + more, "R", place + 1, r, (r, text)) for r in ("user", "assistant")]
            for more, edit, to, role, line in moves:
                then = state if role is None else after.get((state, role[:1]))
                if then is None:
                    continue
                value = (cost + more, audit + edit, out if line is None else (*out, line))
                if (to, then) not in best or value[:2] < best[to, then][:2]:
                    best[to, then] = value
                    changed = True
    ends = [best[k] for k in ((len(rows), "0"), (len(rows), "a")) if k in best]
    return min(ends, key=lambda v: v[:2])


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def judged(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows, solve=relax, wear=damaged):
    result = []
    worn = wear(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted(
            [r for r in worn if r[0] == conv],
            key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in mine if r[1] is not None]
        faults = judged([r[2:] for r in mine])
        cost, audit, lines = solve(faults)
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        pairs = zip(mine, mine[1:])
        result.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[sum(f == kind for _, _, f in faults) for kind in ("blank", "duplicate", "truncated")],
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(result, key=repr)


def query(spark, folder, rows, extra=()):
    frame = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        frame = frame.withColumn(c, F.lit("x"))
    frame.repartition(3).write.parquet(f"{folder}/conversations.parquet")
    got = op12_conversations(spark, str(folder))
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


def some_rows(draw, conversations_, most, turns=True):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "student"]
    texts = ["Well.", "Well.", "And then", "So?", "  ", "", None, "No!\n ", "é…", "x" * 300 + "."]
    rows = []
    for conv in conversations_:
        for turn in range(draw.randrange(most + 1)):
            rows.append((conv, turn if turns and draw.random() < 0.9 else draw.choice([None, 3]),
                         draw.choice(roles), draw.choice(texts)))
    return rows


def test_agenda_finds_what_enumeration_finds():
    draw = random.Random(3)
    for _ in range(60):
        rows = [
            (draw.choice(["system", "user", "assistant", "tool"]), f"t{i}", draw.choice([None, None, "truncated", "blank"]))
            for i in range(draw.randrange(4))
        ]
        want = enumerate_repairs(rows)
        seen = tuple((r[:1].encode() if f != "blank" else b"", f == "truncated", int(f == "blank")) for r, _, f in rows)
        cost, audit = conversations.repair_whole(seen)
        pairs = conversations.repaired(
            [(r.encode(), t.encode(), int(f == "blank")) for r, t, f in rows], audit, 0, conversations._starts_with_system(audit))
        assert (cost, audit, [(r.decode(), t.decode()) for r, t in pairs]) == want
        assert relax(rows)[:2] == want[:2]


def test_query_of_many_small_conversations(spark, tmp_path):
    rows = some_rows(random.Random(8), [None, *range(300)], 9)
    assert query(spark, tmp_path, rows, ["copies", "part", "a.b"]) == brute(rows)


@pytest.mark.parametrize("block,fanin", [(1, 2), (3, 2), (4, 32)])
def test_blocks_of_long_conversations(spark, tmp_path, monkeypatch, block, fanin):
    monkeypatch.setattr(conversations, "BLOCK", block)
    monkeypatch.setattr(conversations, "FANIN", fanin)
    rows = some_rows(random.Random(block), [1, 2, 2, 3, *range(10, 40)], 40)
    assert query(spark, tmp_path, rows) == brute(rows)


def test_a_hot_conversation_is_spread_and_whole(spark, tmp_path):
    draw = random.Random(4)
    rows = [(7, t, draw.choice(["user", "assistant"]), f"Say {t}.") for t in range(900)] + some_rows(draw, range(8, 60), 6)
    assert query(spark, tmp_path, rows) == brute(rows)


def test_a_mass_of_equal_rows(spark, tmp_path):
    rows = [(1, 1, "user", "Same.")] * 400 + [(1, None, "user", "Same.")] * 5 + [(1, 2, "assistant", "Yes.")]
    assert query(spark, tmp_path, rows) == brute(rows)


def test_all_rows_dropped_and_empty_table(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert query(spark, tmp_path / "a", [(gone, 0, "user", "Hi.")]) == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert query(spark, tmp_path / "b", []) == []


def test_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK", 4)
    rows = some_rows(random.Random(2), range(40), 14)
    frame = conversations.damage(spark.createDataFrame(rows, SCHEMA))
    digests = {r.conv_id: r.digest for r in conversations.repair(frame).collect()}
    lines = {}
    for r in conversations.repaired_rows(frame).orderBy("conv_id", "position").collect():
        assert r.position == len(lines.setdefault(r.conv_id, []))
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, digest in digests.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == digest
