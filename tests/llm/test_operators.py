"""Every operator on small tables with odd rows, against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siftworks.llm import (
    chains, components, debruijn, jaccard, language, licenses, lines, mixing, neighbours, packing, topk, toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, start int, token string"


def sentence(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))


LONG = sentence(1, 30_000)
BASE = sentence(2, 60)


@pytest.fixture(scope="module")
def rows():
    words = BASE.split()
    near = " ".join([*words[:50], "other", *words[51:]])
    texts = [
        BASE, BASE, near, None, "", "   ", "one", "one", "One two three four", "one two three four", LONG,
        "x y " + LONG, "prefix " + " ".join(words[10:40]) + " suffix", "same line\nnext line\nown a",
        "other start\nsame line\nnext line\nown b", "a\na\na\na", "\n\n", "été noël garçon", "12 34 !!",
    ]
    sources = itertools.cycle(["hot", "hot", None, "b", "ä"])
    made = [(i, t, "en", s, len(t or ""), 1, "z") for i, (t, s) in enumerate(zip(texts, sources))]
    # Repeated rows, an id with two texts, and rows without an id.
    return [*made, made[0], (6, "another text of six", None, "b", 1, 1, "z"), (None, BASE, None, None, None, None, None),
            (None, "no id at all", "en", "hot", 3, 1, "z")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_mix_meets_targets(docs, rows):
    found = mixing.mix(docs).collect()
    again = {(r.doc_id, r.size, r.source): r.taken for r in mixing.mix(docs.repartition(1)).collect()}
    sizes = Counter()
    for _, text, _, source, *_ in rows:
        sizes[source] += len((text or "").encode().split())
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if 2 * sizes[s] < level * weights[s]}
        targets |= {s: 2.0 * sizes[s] for s in over} if over else {s: level * weights[s] for s in free}
        left -= sum(targets[s] for s in over)
        free = free - over if over else set()
    assert len(found) == len(rows)
    for r in found:
        assert r.taken <= 2 * r.size and again[r.doc_id, r.size, r.source] == r.taken
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
    for source in order:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - targets[source]) <= max(r.size for r in own)


def test_sources_below_their_caps_share_one_level(spark):
    """a is capped at 20; what it leaves, 130, goes to b and c by 2 to 1."""
    sizes = {"a": 10, "b": 45, "c": 45}
    frame = spark.createDataFrame([(n, "x " * size, s) for n, (s, size) in enumerate(sizes.items())],
                                  "doc_id long, text string, source string")
    found = {r.source: (r.size, r.source_size, r.target) for r in mixing.mix(frame).collect()}
    assert found == {s: (n, n, pytest.approx(t)) for (s, n), t in zip(sizes.items(), (20, 260 / 3, 130 / 3))}


def test_mix_repeats_rows_with_their_columns(docs, rows):
    repeated = mixing.repeat(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]


def test_packing_round_trip(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    found = packing.pack(packing.pieces(docs, capacity=256), capacity=256).collect()
    ids = Counter()
    for doc, text, *_ in rows:
        full = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for n, at in enumerate(range(0, len(full), 256)):
            part = full[at:at + 256]
            ids[doc, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == ids
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for some in bins.values():
        ends = list(itertools.accumulate(n for _, n in sorted(some)))
        assert [o for o, _ in sorted(some)] == [0, *ends[:-1]] and ends[-1] <= 256
    assert len(bins) <= 1.1 * sum(r.length for r in found) / 256 + 1


def test_sum_of_squares_follows_its_rule():
    lengths = np.random.default_rng(3).integers(1, 41, 300).tolist()
    where, offsets = packing.sum_of_squares(lengths, 40)
    gaps: dict[int, int] = {}
    cost = lambda g: sum(n * n for size, n in Counter(g.values()).items() if 0 < size < 40)
    for size, bin_, offset in zip(lengths, where, offsets):
        costs = [cost({**gaps, b: gaps[b] - size}) for b in gaps if gaps[b] >= size]
        fresh = cost({**gaps, len(gaps): 40 - size})
        assert offset == 40 - gaps.get(bin_, 40)
        gaps[bin_] = gaps.get(bin_, 40) - size
        assert cost(gaps) == min([*costs, fresh])


def brute_lines(rows, run):
    seen, out = set(), Counter()
    keyed = [(r[0] is None, r[0] or 0, r[1]) for r in rows]
    for none, doc, text in sorted({k for k in keyed if k[2] is not None}, key=lambda k: (k[0], k[1], k[2])):
        parts = text.split("\n")
        gone = set()
        for i in range(len(parts) - run + 1):
            key = tuple(parts[i:i + run])
            if key in seen:
                gone |= set(range(i, i + run))
            seen.add(key)
        out[none, doc, text] = (len(gone), "\n".join(p for i, p in enumerate(parts) if i not in gone))
    return out


def test_line_dedup(docs, rows):
    # Ids with two texts come in order of the texts' hash; these two share no run.
    found = lines.dedup_lines(docs.withColumn("old", F.col("text"))).collect()
    want = brute_lines(rows, 2)
    assert len(found) == len(rows)
    for r in found:
        if r.old is None:
            assert r.text is None and r["_sw_lines"] == 0
        else:
            assert (r["_sw_removed"], r.text) == want[r.doc_id is None, r.doc_id or 0, r.old]


def test_long_lines_are_windows_of_their_own(spark, docs):
    passage, short = sentence(21, 50), sentence(22, 49)
    texts = [
        (1, f"a1\n{passage}\na2"), (2, f"b1\n{passage}\nb2"), (3, passage), (4, f"{short}\nc1"), (5, f"d1\n{short}"), (6, short),
        (7, f"e1\n{passage}\n{passage}\ne2"), (8, f"pair 1\npair 2\n{passage}"), (9, f"pair 1\npair 2\n{passage}\nf1"),
        (10, f"own {passage}"), (None, f"g1\n{passage}"), (None, None), (11, ""), (12, f"h1\n{passage} "), (2, f"b1\n{passage}\nb2"),
    ]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("old", F.col("text"))
    seen, want = set(), {}
    for doc, text in sorted({t for t in texts if t[1] is not None}, key=lambda t: (t[0] is None, t[0] or 0, t[1])):
        parts, gone = text.split("\n"), set()
        for size in (1, 2):
            for i in range(len(parts) - size + 1):
                key = tuple(parts[i:i + size])
                if size == 2 or len(key[0].split()) >= 50:
                    gone |= set(range(i, i + size)) if key in seen else set()
                    seen.add(key)
        want[doc, text] = (len(gone), "\n".join(p for i, p in enumerate(parts) if i not in gone))
    found = lines.dedup_lines(frame, long_line=50).collect()
    assert len(found) == len(texts)
    assert all((r["_sw_removed"], r.text) == want.get((r.doc_id, r.old), (0, None)) for r in found)
    assert want[2, texts[1][1]] == (1, "b1\nb2") and want[3, passage] == (1, "") and want[6, short] == (0, short)
    # The pipeline cuts them too.
    cut = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, frame.select("doc_id", "text"), "").collect()}
    assert cut[2] == "b1\nb2" and 3 not in cut and cut[6] == short and cut[9] == "f1"


def test_substrings_of_ids_with_a_copied_and_another_text(spark):
    copied, other, early = sentence(31, 40), sentence(32, 60).split(), sentence(33, 40).split()
    # Id 3 has a copy of id 1's text and one of its own, which repeats id 2 and is repeated by id 4.
    rows = [(1, copied), (2, " ".join(early)), (3, copied), (3, " ".join([*early[:20], *other])),
            (4, " ".join(["x", *other[10:40], "y"])), (5, copied), (5, "a short one"), (None, copied)]
    test_substrings(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_substrings(docs, rows):
    found = debruijn.dedup(docs).collect()
    first: dict = {}
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - 12):
            if doc is not None:
                key = tuple(words[i:i + 13])
                first[key] = min(first.get(key, doc), doc)
    want = Counter()
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        gone = {j for i in range(len(words) - 12) if doc is not None and first[tuple(words[i:i + 13])] < doc
                for j in range(i, i + 13)}
        want[doc, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in found) == want


def brute_components(rows):
    sets = [(doc, frozenset(tuple(w[i:i + min(5, len(w))]) for i in range(max(1, len(w) - 4))) if w else frozenset())
            for doc, text, *_ in rows for w in [(text or "").encode().lower().split()]]
    label = {doc: doc for doc, _ in sets if doc is not None}
    for _ in sets:
        for (a, x), (b, y) in itertools.combinations(sets, 2):
            if x and y and a is not None and b is not None and 100 * len(x & y) >= 75 * len(x | y):
                label[a] = label[b] = min(label[a], label[b])
    return sets, label


def test_jaccard(docs, rows):
    found = jaccard.near_duplicates(docs)
    sets, label = brute_components(rows)
    want = Counter()
    for doc, x in sets:
        same = [label[d] for d, y in sets if d is not None and x and x == y]
        want[doc, len(x), label[doc] if doc is not None else min(same, default=None)] += 1
    assert Counter(map(tuple, found.collect())) == want


def test_jaccard_finds_links_beyond_pivots(spark):
    """Many edited copies of one text, most of which link only through others."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(150):
        words = BASE.split()[:40]
        for i in rng.choice(40, int(rng.integers(0, 3)), replace=False):
            words[i] = f"v{rng.integers(10**6)}"
        texts.append(" ".join(words))
    short = [" ".join(rng.choice(list("abcdef"), rng.integers(1, 14))) for _ in range(150)]
    rows = list(enumerate([*texts, *short]))
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    _, label = brute_components(rows)
    assert {r.doc_id: r.component_id for r in found.collect()} == label


def test_jaccard_writes_no_entry_of_one_class(spark, monkeypatch):
    """What stands on disk at once follows what sets share, not all shingles."""
    texts = [" ".join(f"w{i}x{k}" for k in range(200)) for i in range(30)]
    made = [(i, text) for i, text in enumerate([*texts, texts[0], texts[1] + " end"])]
    wide = jaccard.Join(spark.createDataFrame(made, "doc_id long, text string"))
    written = []

    def scratch(self, frame, name, write=jaccard.Scratch.__call__):
        table = write(self, frame, name)
        written.append((name, table.count()))
        return table

    monkeypatch.setattr(jaccard.Scratch, "__call__", scratch)
    label = {r.node: r.label for r in wide.labels().collect()}
    assert len(label) == 2 and len(set(label.values())) == 1
    assert max(rows for _, rows in written) <= 2 * 50  # 31 classes have some 50 entries each
    assert dict(written)["near"] == 1  # equal texts are one class already


def test_shared_marks_bound_the_overlap():
    rng = np.random.default_rng(5)
    for n, m, common in [(1, 1, 1), (900, 1100, 700), (5000, 4000, 0), (200_000, 150_000, 120_000)]:
        drawn = rng.integers(0, 1 << 64, n + m - common, np.uint64)
        x, y = np.unique(drawn[:n]), np.unique(drawn[n - common:])
        marks = jaccard.marks_of(x), jaccard.marks_of(y)
        assert jaccard.shared_marks(*marks) == sum((Counter(marks[0].tolist()) & Counter(marks[1].tolist())).values())
        assert jaccard.shared_marks(*marks) >= len(np.intersect1d(x, y))


def test_jaccard_lists_a_class_once_a_task(spark):
    texts = spark.createDataFrame([("a b c d e f g h",)] * 50 + [("short text",)] * 50, "text string").coalesce(1)
    none = np.zeros(0, np.uint64)
    rows = jaccard.entries(texts.selectExpr("cast(text as binary) AS text"), none, 1).collect()
    assert len({(r.token, r.node) for r in rows}) == len(rows) == 3
    assert sorted((r.n, r.own == r.node if r.own else None) for r in rows) == [(1, True), (4, None), (4, None)]


def test_jaccard_of_an_id_with_a_short_and_a_containing_text(spark):
    long = [sentence(100 + i, 240).split() for i in range(12)]
    # The long text has the whole short one, whose entries the id's long text mostly has too.
    made = [(i, " ".join(words[:40])) for i, words in enumerate(long)]
    made += [(i, " ".join(words)) for i, words in enumerate(long)]
    made += [(100 + i, " ".join([*words[:39], "other"])) for i, words in enumerate(long)]
    made += [(200, None), (200, ""), (None, made[0][1]), (None, sentence(99, 30)), (201, made[1][1])]
    test_jaccard(spark.createDataFrame(made, "doc_id long, text string"), made)


@pytest.mark.parametrize("n", range(1, 13))
def test_light_sets_meet_in_a_subset(n):
    for m in range(1, 13):
        for shared in range(min(n, m) + 1):
            if 100 * shared >= 75 * (n + m - shared):
                need = jaccard.least_overlap(n, m)
                assert shared >= need
                assert need in jaccard.subset_sizes(n, 12) and need in jaccard.subset_sizes(m, 12)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 7), (500, 501), (5, 5)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    label = {r.node: r.label for r in found}
    assert {label[i] for i in range(100, 141)} == {100} and {label[i] for i in [3, 7, *range(8, 60)]} == {3}
    assert label[501] == 500 and len(found) == len(label)


def test_licenses(spark, docs, rows):
    texts = [
        (1, "x Under the MIT  License. under-the-mit-license"), (2, None), (3, ""),
        (4, "Licensed under the Apache License, Version 2.0."), (5, "cc by nc nc by cc CC_BY_NC"),
        (6, "This work is licensed under the GNU General Public License, version 3."), (7, "the license of the software"),
    ]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    places = lambda d: [(b.label, b.first_word) for b in found[d].base]
    assert places(1) == [("mit", 1), ("mit", 5)] and found[1].n_words == 9
    assert found[2].n_words == found[3].n_words == 0 and places(2) == []
    assert places(4) == [("apache-2", 3)] and places(5) == [("cc-by-nc", 0), ("cc-by-nc", 6)]
    assert [s.label for s in found[6].spans] == ["gpl-3"] and found[6].spans[0].cover == 1.0
    assert found[7].spans == [] and licenses.scan(docs).count() == len(rows)


def test_automaton_has_every_run():
    sequences = [[1, 2, 1, 3, 1, 2], [2, 1, 3, 3], [1, 2, 1, 3, 3, 3]]
    automaton = licenses.Automaton(sequences)
    stream = np.random.default_rng(1).integers(1, 5, 400).tolist()
    runs = {tuple(s[i:j]): set() for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for n, s in enumerate(sequences):
        for i, j in itertools.combinations(range(len(s) + 1), 2):
            runs[tuple(s[i:j])].add((n, j - 1))
    for at, (length, state) in enumerate(automaton.statistics(stream)):
        longest = next((k for k in range(min(6, at + 1), 0, -1) if tuple(stream[at + 1 - k:at + 1]) in runs), 0)
        assert length == longest
        if length:
            assert set(automaton.ends[state]) == runs[tuple(stream[at + 1 - length:at + 1])]


@pytest.fixture(scope="module")
def model(spark):
    english = ["the cat and the dog were in the house", "this is the way of the world"] * 4
    german = ["der hund und die katze waren im haus", "das ist der lauf der welt"] * 4
    russian = ["кошка и собака были в доме", "так устроен этот мир"] * 4
    made = [(i, t, lang) for i, (lang, t) in enumerate(
        [("en", t) for t in english] + [("de", t) for t in german] + [("ru", t) for t in russian])]
    return language.fit(spark.createDataFrame(made, "doc_id long, text string, lang string"), F.col("doc_id"))


def test_language(spark, docs, rows, model):
    texts = [(1, "the dog and the world"), (2, "der hund und die welt"), (3, "собака и дом"), (4, None), (5, ""),
             (6, "12 !! 34"), (7, "the cat and the dog were in the house " + "der hund und die katze waren im haus")]
    found = {r.doc_id: r for r in language.label(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert [found[i].lang_pred for i in range(1, 7)] == ["en", "de", "ru", "und", "und", "und"]
    assert [(s.first_word, s.last_word, s.lang) for s in found[7].spans] == [(0, 8, "en"), (9, 16, "de")]
    assert found[4].score == 0 and all(0 <= r.score <= 1 for r in found.values())
    assert language.label(docs, model).count() == len(rows)
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and "12 34 !!" not in {r.text for r in kept.collect()}
    empty = language.fit(docs.limit(0), F.col("doc_id"))
    assert {r.lang_pred for r in language.label(docs, empty).collect()} == {"und"}


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)
    lengths = np.array([5, 3, 1])
    scores = -rng.random((9, 3)) * 5
    got = language.viterbi(scores, chains.Steps(lengths), 2.0)
    for n, end in zip(lengths, np.cumsum(lengths)):
        own = scores[end - n:end]
        value = lambda p: sum(own[i, s] for i, s in enumerate(p)) - 2 * sum(a != b for a, b in itertools.pairwise(p))  # noqa: E731,B023
        assert value(got[end - n:end]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=int(n)))))


def test_marginals_against_all_paths():
    rng = np.random.default_rng(6)
    lengths, trans = np.array([4, 2]), rng.normal(size=(2, 2))
    emission = rng.normal(size=6)
    got, expected, _ = toxicity.marginals(emission, chains.Steps(lengths), trans)
    total = np.zeros((2, 2))
    for n, end in zip(lengths, np.cumsum(lengths)):
        own, paths = emission[end - n:end], list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([math.exp(sum(own[i] * s for i, s in enumerate(p)) + sum(trans[a, b] for a, b in itertools.pairwise(p))) for p in paths])
        weight /= weight.sum()
        assert np.allclose(got[end - n:end], [sum(w for w, p in zip(weight, paths) if p[i]) for i in range(n)])
        for w, p in zip(weight, paths):
            for a, b in itertools.pairwise(p):
                total[a, b] += w
    assert np.allclose(expected, total)


def test_toxicity(spark, docs, rows):
    made = [(i, f"{sentence(i, 30)} {'rotten scoundrel ' if i % 3 == 0 else ''}{sentence(i + 999, 20)}") for i in range(300)]
    texts = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    tagger = toxicity.fit(texts, labels, F.col("doc_id") % 5 != 0)
    held = [r for r in toxicity.score(texts, tagger).collect() if r.doc_id % 5 == 0]
    assert all((r.score >= 0.5) == (r.doc_id % 3 == 0) for r in held)
    assert {(s.first_word, s.last_word) for r in held for s in r.spans} == {(30, 31)}
    found = toxicity.score(docs, tagger).collect()
    assert len(found) == len(rows) and all(0 <= r.score < 0.5 for r in found)
    nothing = toxicity.fit(texts, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).astype("f4").tolist(), "x") for i in range(600)]
    rows += [(600 + i, rows[0][1], "copy") for i in range(40)]
    rows += [(i, rng.normal(size=4).tolist(), "short") for i in (700, 701, 800)]
    odd = [(900, None, ""), (901, [], ""), (902, [0.0] * 16, ""), (903, [float("nan")] * 16, ""),
           (904, [None] * 16, ""), (905, [float("inf")] * 16, ""), (None, rows[1][1], ""), (1, rows[2][1], "twice")]
    return rows + odd, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, shard string")


def brute_search(rows, queries, score, k, zeros):
    good = [(i, np.array(e, float)) for i, e, _ in rows if i is not None and e and None not in e
            and np.isfinite(np.array(e, float)).all() and (zeros or np.any(e))]
    out = {}
    for q, x in good:
        if q % queries == 0:
            best: dict = out.setdefault(q, {})
            for i, y in good:
                if i != q and len(x) == len(y):
                    best[i] = min(best.get(i, math.inf), score(x, y))
    return {q: sorted((s, i) for i, s in best.items())[:k] for q, best in out.items() if best}


def by_query(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_exact_top_k(vectors, monkeypatch):
    rows, frame = vectors
    product = lambda x, y: -int(np.floor(256 * x) @ np.floor(256 * y))
    want = brute_search(rows, 50, product, 5, True)
    got = by_query(topk.search(frame, F.col("vec_id") % 50 == 0))
    assert {q: [(-s, i) for s, i in some] for q, some in got.items()} == want
    assert topk.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.whole(np.array([[1e200, 1.0]]), 256.0).dtype == object


def test_neighbours_recall(vectors):
    rows, frame = vectors
    want = brute_search(rows, 100, lambda x, y: float(np.sqrt(((x - y) ** 2).sum())), 10, False)
    got = by_query(neighbours.search(frame, F.col("vec_id") % 100 == 0, enough=100))
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert got[0][0] == (0.0, 600) and [i for _, i in got[0]] == list(range(600, 610))
    assert neighbours.search(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_probing_finds_every_code_in_the_radius():
    rng = np.random.default_rng(9)
    codes = rng.integers(0, 256, (500, 8)).astype(np.uint8)
    rows, begins = neighbours.index(codes)
    code = codes[0].astype(np.int64)
    far = np.bitwise_count(codes ^ codes[0]).sum(axis=1)
    for enough in (1, 3, 50):
        found = neighbours.within(code, codes, rows, begins, enough)
        radius = next(8 * (p + 1) for p in range(9) if (far < 8 * (p + 1)).sum() >= enough)
        assert set(found) == set(np.flatnonzero(far < radius))


def test_empty_documents(docs):
    none = docs.limit(0)
    for result in (mixing.mix(none), mixing.repeat(none), packing.pack(packing.pieces(none)), lines.dedup_lines(none),
                   debruijn.dedup(none), jaccard.near_duplicates(none), licenses.scan(none)):
        assert result.count() == 0


def test_pipeline_stages(spark, docs, rows, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    current, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, current, str(tmp_path)).write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
        seen[name] = current.collect()
        assert n == 4 or current.columns == docs.columns
    assert not {None, "", "   ", "\n\n", "12 34 !!"} & {r.text for r in seen["language_id"]}
    for r in seen["line_dedup"]:
        assert r.text.strip() and "same line\nnext line" not in r.text or r.doc_id == 13
    kept = [r.doc_id for r in seen["ngram_jaccard"] if r.doc_id is not None]
    assert len(kept) == len(set(kept)) and 0 in kept and 1 not in kept and 11 not in kept
    assert len({r.sequence_id for r in seen["packing"]}) == len({(r.sequence_id) for r in seen["packing"] if r.offset == 0})
    result = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "ids_crc32").collect()
    assert Counter(map(tuple, result)) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in seen["packing"])


def test_pipeline_keeps_a_row_of_every_group_of_texts(spark):
    a, b, c, d, e, f = (sentence(50 + i, 60) for i in range(6))
    near = lambda text: text.rsplit(" ", 1)[0] + " other"
    made = [(1, a), (1, b), (1, c), (2, near(b)), (3, a), (None, a), (None, d), (None, d), (None, near(d)), (4, e), (4, e),
            (4, f), (4, near(f)), (5, ""), (None, None), *[(6, sentence(70 + i, 30)) for i in range(9)]]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    found = Counter(map(tuple, corpus_pipeline.ngram_jaccard(spark, frame, "").collect()))
    either = lambda doc, text: found.pop((doc, text), 0) + found.pop((doc, near(text)), 0)
    assert either(None, d) == 1 and either(4, f) == 1
    assert found == Counter([(1, c), (2, near(b)), (3, a), (4, e), (5, ""), (None, None), *made[-9:]])


def test_kept_digest_matches_text(docs):
    row = debruijn.dedup(docs.where("doc_id = 0")).select("kept", F.sha2("kept", 256).alias("h")).first()
    assert row.h == hashlib.sha256(bytes(row.kept)).hexdigest()


def test_mix_parts_rows_without_ids(spark):
    """Targets are met where ids are null or repeated and where rows are equal."""
    made = [(None, f"{'w ' * (1 + i % 20)}{i}", "a") for i in range(3000)] + [(7, "same text here", "b")] * 900 + [
        (i, "x y", "c") for i in range(200)]
    frame = spark.createDataFrame(made, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(frame).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"))
    for r in found.collect():
        assert abs(r.taken - r.target) <= r.most


def test_odd_column_names_pass_through_mixing(spark):
    names = ["doc_id", "text", "source", "_epochs", "_prefix", "_draw", "a.b", "c`d", "size"]
    frame = spark.createDataFrame([(i, "x y z", "s", 1, 2, 3, 4, 5, 6) for i in range(20)], names)
    mixed = mixing.repeat(frame)
    assert mixed.columns == names and set(map(tuple, mixed.collect())) <= set(map(tuple, frame.collect()))
    with pytest.raises(ValueError, match="_sw_"):
        mixing.repeat(frame.withColumnRenamed("size", "_sw_source"))


def test_texts_of_one_id_never_share_a_key(spark, docs, rows, monkeypatch):
    """Keys that collide under the first salts give what keys that don't give."""
    long = [(9, sentence(300, 50) + " " + sentence(301, 40)), (9, sentence(302, 14)), (12, sentence(300, 50)),
            (12, sentence(303, 90) + " " + sentence(301, 40)), (12, sentence(302, 14)), (13, "a b")]
    frame = spark.createDataFrame(long, "doc_id long, text string")
    key = lambda r: (r.doc_id, r.n_words, r.n_removed, bytes(r.kept))
    want = sorted(map(key, debruijn.dedup(frame).collect()))
    assert sum(n for _, _, n, _ in want) == 50 + 40 + 14
    plain = debruijn.text_key
    monkeypatch.setattr(debruijn, "text_key", lambda salt, *h: F.lit(3).cast("long").alias("text_key") if salt < 2 else plain(salt, *h))
    assert sorted(map(key, debruijn.dedup(frame).collect())) == want


def test_kept_words_give_the_ids_of_whole_texts(monkeypatch):
    """Odd words, special tokens, marks that compose, and forgotten words."""
    draw = random.Random(12)
    letters = "abzAZ09'\u2019.,;:!?\"-sStTre \u00e9\u00c9\u00fc\u00df\u0130\u03a3\u017f\u0301\u0308\u2026\u00ab\u00bd\u00b2\u200b\u65e5\u212a\ufb01\x00\x1c\x85"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(30))) for _ in range(3000)]
    texts += ["<|endoftext|>x <|STARTOFTEXT|> <|", "Don't I'LL ''s 'tis a's's \u00c9t\u00e9's 12.5%", "T\u0308 T \u0308", ""]
    for kept in (3, 100_000):
        monkeypatch.setattr(packing, "WORDS_KEPT", kept)
        monkeypatch.setattr(packing, "PARTS_KEPT", kept)
        encode = packing.Encoder(packing.tokenizer_path())
        for text in texts:
            assert encode(text.encode()) == packing.pack_ids(encode.tokenizer.encode(text, add_special_tokens=False).ids)


def test_odd_column_names_pass_through_language_id(spark, docs, tmp_path):
    odd = docs.withColumn("a.b", F.lit(1)).withColumn("c`d", F.lit("x")).withColumn("c0", F.lit(2))
    kept = corpus_pipeline.language_id(spark, odd, str(tmp_path))
    plain = corpus_pipeline.language_id(spark, docs, str(tmp_path))
    assert kept.columns == odd.columns and kept.count() == plain.count() > 0
    assert kept.limit(0).count() == 0
