"""Token counts against the library's own encoding."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from siftworks.llm import tokencounts

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokencounts.tokenizer_path())


@pytest.fixture(scope="module")
def counter():
    return tokencounts.counter()


def length(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


TEXTS = [
    "", " ", "  \n\t ", "a", "don't we'll they'd I'm you've it's we're", "x" * 5000,
    "<|endoftext|>", " <|endoftext|> <|endoftext|><|endoftext|>  ", "a  <|endoftext|>b", "<|endoftext",
    "tab\tand  two   spaces \n\n\n new", "1234567890 12 ½ ² Ⅷ", "naïve Ünïcode éèêë", "日本語のテキスト 漢字",
    "\U0001F600\U0001F468‍\U0001F469", "  wide　spaces end\x85\x1c\x1d\x0b\x0c",
    "͸ unassigned ࢏ ౜ ꟎ \U0001e6c0 \U0003d000", "a\x00b\x07", "-- == !? ''' \"\" ...",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(library, counter, text):
    assert counter(text) == length(library, text)


def test_random_texts_of_all_planes(library, counter):
    draw = random.Random(5)
    pools = [range(0x20, 0x7F), range(0x80, 0x600), range(0x2000, 0x2100), range(0x4E00, 0x4F00), range(0x10400, 0x10500)]
    for _ in range(400):
        text = "".join(chr(draw.choice(draw.choice(pools))) + " " * draw.choice([0, 0, 0, 1, 2]) for _ in range(60))
        assert counter(text) == length(library, text)


def test_every_class_of_a_disagreeing_code_point_goes_to_the_library(library, counter):
    disagreed = sorted(c for block in (0x05, 0x08, 0x0C, 0xA7) for c in counter._disagreed(block))
    for c in disagreed:
        text = f"a{c}b 1{c}2 {c}{c} !{c}"
        assert counter(text) == length(library, text)


def test_chunks_change_nothing(library, counter, monkeypatch):
    text = "some words  and\n\nlines; " * 40 + "x" * 300 + "   "
    want = length(library, text)
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(tokencounts, "CHUNK", size)
        assert counter(text) == want


def test_whole_tokens_are_proven(library, counter):
    assert len(counter.whole) > 40_000
    for piece in random.Random(1).sample(sorted(counter.whole), 500):
        assert counter.merge(piece) == 1


def test_kept_merges_may_be_dropped(library, counter, monkeypatch):
    monkeypatch.setattr(tokencounts, "MERGED_KEPT", 3)
    texts = [f"qzx{i}vvkw zzqj{i}" for i in range(30)]
    assert [counter(t) for t in texts] == [length(library, t) for t in texts]


def test_rows(spark, library):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again"), (3, "again"), (99, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_tokens", "'x' AS `a.b`")
    got = tokencounts.count(frame, limit=3).collect()
    want = [(d, len((t or "").encode()), length(library, t or "")) for d, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 3) for r in got)


def test_bytes_that_are_no_text(spark, library):
    frame = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    row = tokencounts.count(frame).first()
    assert (row.n_bytes, row.n_tokens) == (3, length(library, "a�b"))


def test_empty_table(spark):
    assert tokencounts.count(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokencounts.TokenCounter(tokencounts.tokenizer_path("word_bpe_49k.json"))
