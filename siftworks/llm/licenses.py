"""License scans with a generalised suffix automaton.

The automaton holds every run of words of every template. Streaming a file through it
gives, at each word, the longest run ending there that occurs in some template (the
matching statistics). Runs of ``min_match`` words or more that can't be extended are
matches; matches that follow each other in a template and in the file, at most
``max_gap`` words apart, chain into one template span. A span that covers ``min_cover``
of its template's words carries that template's label. Phrases are short templates
that count wherever all their words stand in a row.

Words outside all templates reset the automaton, so only stretches of known words are
walked; every word of the whole file is looked up.

Results for odd input: null and empty texts have no words and no labels; overlapping
and repeated phrases all count; equal rows get equal answers; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import raw_text, rows_of

#: The phrases that name a license, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Openings and notices of well-known licenses, by label.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the \"Software\"), to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software",
        "Released under the MIT License",
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at",
        "Licensed under the Apache License, Version 2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    "gpl-3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License",
        "This work is licensed under the GNU General Public License, version 3",
    ),
    "gpl-2": ("This work is licensed under the GNU General Public License, version 2",),
    "lgpl-3": ("This work is licensed under the GNU Lesser General Public License, version 3",),
    "mpl-2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License",),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
    ),
    "all-rights-reserved": ("All rights reserved",),
}

#: ASCII bytes that are no letters or digits separate words; A-Z become a-z.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Match(NamedTuple):
    """A run of ``length`` words from ``start``, and where templates have it: (template, start)."""

    start: int
    length: int
    places: tuple[tuple[int, int], ...]


class Automaton:
    """Generalised suffix automaton over lists of word numbers."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        self._ends = ends
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                ends[last].add((number, at))
        # A shorter run ends wherever the longer runs that end with it end.
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [tuple(sorted(e)) for e in ends]

    def _new(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.length.append(length)
        self.link.append(link)
        self._ends.append(set())
        return len(self.length) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        """A copy of ``state`` for its runs of at most length(before) + 1 words."""
        copy = self._new(self.length[before] + 1, dict(self.next[state]), self.link[state])
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        self.link[state] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        state, before = self._new(self.length[last] + 1, {}, 0), last
        while before >= 0 and word not in self.next[before]:
            self.next[before][word] = state
            before = self.link[before]
        if before >= 0:
            other = self.next[before][word]
            same = self.length[other] == self.length[before] + 1
            self.link[state] = other if same else self._split(before, word, other)
        return state

    def statistics(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        """At each word the length of the longest run ending there, and its state."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield length, state


class Scanner:
    def __init__(
        self, templates: dict[str, tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
        min_match: int = 3, max_gap: int = 6, min_cover: float = 0.7,
    ) -> None:
        texts = [(label, words_of(t.encode())) for label, some in templates.items() for t in some]
        self.labels = [label for label, _ in texts]
        self.sizes = [len(words) for _, words in texts]
        self.phrases = [(label, words_of(p.encode())) for p, label in phrases.items()]
        every = [w for _, some in [*texts, *self.phrases] for w in some]
        self.numbers = {w: i for i, w in enumerate(dict.fromkeys(every))}
        coded = lambda some: [self.numbers[w] for w in some]
        self.phrases = [(label, coded(p)) for label, p in self.phrases]
        self.automaton = Automaton([coded(words) for _, words in texts])
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        self.shortest = min([min_match, *[len(p) for _, p in self.phrases]])

    def stretches(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Start and numbers of each stretch of template words long enough to matter."""
        numbers = np.fromiter(map(self.numbers.get, words, _minus_ones()), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], numbers >= 0, [0]]).astype(np.int8)))
        for first, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - first >= self.shortest:
                yield first, numbers[first:end].tolist()

    def matches(self, first: int, numbers: list[int]) -> Iterator[Match]:
        """Matches that can't be extended to the right; each is the longest ending there."""
        held = (0, 0)
        for at, (length, state) in enumerate([*self.automaton.statistics(numbers), (0, 0)]):
            if length != held[0] + 1 and held[0] >= self.min_match:
                n, s = held
                yield Match(first + at - n, n, tuple((t, e - n + 1) for t, e in self.automaton.ends[s]))
            held = (length, state)

    def spans(self, matches: list[Match]) -> list[tuple[str, int, int, float]]:
        """Chained template spans: label, first and last word, covered share."""
        open_: dict[int, list] = {}
        done = []
        for start, length, places in matches:
            for template, at in places:
                chain = open_.get(template)
                if chain and start > chain[1] and start - chain[1] <= self.max_gap + 1 and at > chain[2]:
                    chain[1], chain[2], chain[3] = start + length - 1, at + length - 1, chain[3] + length
                else:
                    if chain:
                        done.append((template, *chain))
                    open_[template] = [start, start + length - 1, at + length - 1, length]
        done += [(template, *chain) for template, chain in open_.items()]
        covered = ((t, first, last, n / self.sizes[t]) for t, first, last, _, n in done)
        return sorted(
            (self.labels[t], first, last, min(1.0, share)) for t, first, last, share in covered
            if share >= self.min_cover)

    def scan(self, text: bytes) -> tuple:
        """n_words, base places (label, first word), spans."""
        words = words_of(text)
        base, spans = [], []
        matches: list[Match] = []
        for first, numbers in self.stretches(words):
            for label, phrase in self.phrases:
                n = len(phrase)
                base += [(label, first + i) for i in range(len(numbers) - n + 1) if numbers[i:i + n] == phrase]
            matches += self.matches(first, numbers)
        if matches:
            spans = self.spans(matches)
        return len(words), sorted(base, key=lambda b: b[1]), spans


def _minus_ones() -> Iterator[int]:
    while True:
        yield -1


SCANNED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("base", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))),
    ("spans", pa.list_(pa.struct([
        ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())]))),
])


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_words, base (places of phrases), spans (covered templates) of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**options)
        for batch in batches:
            out = defaultdict(list)
            for doc, text in rows_of([batch]):
                n, base, spans = scanner.scan(text or b"")
                out["doc_id"].append(doc)
                out["n_words"].append(n)
                out["base"].append([{"label": x, "first_word": f} for x, f in base])
                out["spans"].append([dict(zip(("label", "first_word", "last_word", "cover"), s, strict=True)) for s in spans])
            if out:
                yield pa.RecordBatch.from_pydict(out, schema=SCANNED)

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col)).mapInArrow(
        run, "doc_id long, n_words long, base array<struct<label:string,first_word:long>>,"
        " spans array<struct<label:string,first_word:long,last_word:long,cover:double>>")
