"""The Merkle manifest against a plain recursion over whole levels."""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from siftworks.llm import merkle
from siftworks.llm.queries import op11_merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    texts = [None if v is None else str(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])]
    return H(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(digests):
    """Root, and for each leaf its path of (left, right)."""
    paths = [[] for _ in digests]
    members = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(i, min(i + 3, len(digests))) for i in range(0, len(digests), 3)]
        for run in runs:
            for i in run:
                left, right = "".join(digests[run[0]:i]), "".join(digests[i + 1:run[-1] + 1])
                for m in members[i]:
                    paths[m].append((left, right))
        members = [sum((members[i] for i in run), []) for run in runs]
        digests = [H(*digests[run[0]:run[-1] + 1]) for run in runs]
    return digests[0], paths


def brute(rows):
    def place(row):
        return (row["source"] is not None, (row["source"] or "").encode())

    rows = sorted(rows, key=lambda r: (place(r), r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    groups = [list(g) for _, g in groupby(rows, key=place)]
    subtrees = [tree([leaf(r) for r in g]) for g in groups]
    root, tops = tree([s for s, _ in subtrees])
    out = []
    for group, (subroot, paths), top in zip(groups, subtrees, tops, strict=True):
        for row, path in zip(group, paths, strict=True):
            sides = path + top
            changed = dict(row)
            if row["doc_id"] is not None and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                changed["text"] = row["text"].replace("\n", "")
            node = leaf(changed)
            for left, right in sides:
                node = H(left, node, right)
            out.append((row["doc_id"], leaf(row), subroot, root, H(*[a + b for a, b in sides]), node, node == root))
    return out


def found(spark, tmp_path, rows, extra=()):
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    for c in extra:
        frame = frame.withColumn(c, F.lit("x"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


def document(i, source, text="a\nb", lang="en"):
    return {"doc_id": i, "source": source, "lang": lang, "n_chars": None if text is None else len(text), "text": text}


ODD = [
    document(5, None, "x"), document(None, "b", "y\n"), document(None, None, None), document(7, "é"),
    document(7, "é"), document(7, "é", "other\n"), document(-3, "Z", "", None), document(8, "z" * 40, "long " * 5000),
    document(9, "", "\n\n"), document(2, "b", None),
]


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 28])
def test_small_trees(spark, tmp_path, count):
    rows = [document(7 * i % 31, "web", f"text\n{i}") for i in range(count)]
    assert found(spark, tmp_path, rows) == sorted(brute(rows), key=repr)


def test_odd_rows_and_extra_columns(spark, tmp_path):
    rows = [*ODD, *[document(i, f"s{i % 4}", f"t\n{i % 9}") for i in range(300)]]
    assert found(spark, tmp_path, rows, ["digest", "path", "a.b", "size"]) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("digits", [1, 2])
def test_many_rounds_and_a_hot_source(spark, tmp_path, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "WIDTH", 3 ** digits)
    rows = [*ODD, *[document(i, "hot", f"t\n{i}") for i in range(200)], *[document(i, f"s{i:03d}") for i in range(30)]]
    assert found(spark, tmp_path, rows) == sorted(brute(rows), key=repr)


def test_equal_rows_in_masses(spark, tmp_path):
    rows = [document(4, "copy", "same\n")] * 260 + [document(i, "copy", f"{i}") for i in range(10)]
    assert found(spark, tmp_path, rows) == sorted(brute(rows), key=repr)


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, []) == []


def test_division_into_fields_shows(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("ab-", None)], "a string, b string")
    digests = rows.select(merkle.leaf_digest([F.col("a"), F.col("b")]).alias("d")).collect()
    assert len({r.d for r in digests}) == 3


def test_no_join_of_leaves(spark):
    """Proofs come from one nested row per block: the only joins are of blocks to their paths."""
    frame = spark.createDataFrame([tuple(document(i, "s").values()) for i in range(20)], SCHEMA)
    plan = merkle.manifest(frame)._jdf.queryExecution().optimizedPlan().toString()
    generate = plan.index("Generate")
    assert "Join" not in plan[:generate] and "Window" not in plan
