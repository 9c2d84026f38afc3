"""Chains over the words of many documents at once.

Documents of similar length are taken together and their words are laid out step by
step (every document's first word, then every second word, ...), so that a recursion
along the words is a few array operations per step for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Words of one group of documents; a single longer document is a group of its own.
GROUP_WORDS = 400_000


_BMP = 1 << 16
_LETTERS: list[np.ndarray] = []
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(value: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can serve as a hash."""
    value = value * _MIX
    value ^= value >> np.uint64(29)
    value = value * _MIX
    return value ^ (value >> np.uint64(32))


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(_BMP)]))
    found = _LETTERS[0][np.minimum(codes, _BMP - 1)]
    for code in np.unique(codes[codes >= _BMP]).tolist():
        found[codes == code] = chr(code).isalpha()
    return found


class Letters:
    """The lower-case letters of many words at once: ``code``, and the ``word`` each is in."""

    def __init__(self, words: list[bytes]) -> None:
        text = b"\n".join(words).decode("utf-8", "replace").lower()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        owner = np.cumsum(codes == 10)
        letter = _is_letter(codes)
        self.words = len(words)
        self.code, self.word = codes[letter].astype(np.uint64), owner[letter]
        self.counts = np.bincount(self.word, minlength=self.words)
        self.at = np.arange(len(self.word)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word's letters."""
        powers = np.cumprod(np.full(self.counts.max(initial=0) + 1, 0x100000001B3, np.uint64))
        sums = np.zeros(self.words, np.uint64)
        full = np.flatnonzero(self.counts)
        if len(full):
            begins = (np.cumsum(self.counts) - self.counts)[full]
            sums[full] = np.add.reduceat((self.code + np.uint64(1)) * powers[self.at], begins)
        return mixed(sums)

    def shifted(self, by: int) -> np.ndarray:
        """The letter ``by`` places on in the same word, else 0."""
        out = np.zeros_like(self.code)
        if by > 0:
            out[:-by] = np.where(self.word[by:] == self.word[:-by], self.code[by:], 0)
        else:
            out[-by:] = np.where(self.word[:by] == self.word[-by:], self.code[:by], 0)
        return out


class Words:
    """A number for every distinct word, and a row of ``score(words)`` at that number."""

    def __init__(self, score: Callable[[list[bytes]], np.ndarray], width: int, kept: int = 400_000) -> None:
        self.score, self.kept = score, kept
        self.known: dict[bytes, int] = {}
        self.rows = np.zeros((1024, width), np.float32)

    def take(self, words: list[bytes]) -> np.ndarray:
        """The rows of the given words."""
        if len(self.known) > self.kept:
            self.known.clear()
        known = self.known
        new = list(set(words).difference(known))
        if new:
            end = len(known) + len(new)
            if end > len(self.rows):
                grown = np.zeros((2 * end, self.rows.shape[1]), np.float32)
                grown[:len(known)] = self.rows[:len(known)]
                self.rows = grown
            self.rows[len(known):end] = self.score(new)
            known.update(zip(new, range(len(known), end), strict=True))
        return self.rows[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]


class Steps:
    """The layout of documents with ``lengths`` words, longest first."""

    def __init__(self, lengths: np.ndarray) -> None:
        ends = np.cumsum(lengths)
        step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        self.lengths = lengths
        self.order = np.argsort(step, kind="stable")
        self.active = np.bincount(step, minlength=1) if len(step) else np.zeros(0, np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.active)])

    def forward(self) -> Iterator[tuple[int, int, int]]:
        for t in range(len(self.active)):
            yield t, self.begin[t], self.begin[t + 1]

    def backward(self) -> Iterator[tuple[int, int, int]]:
        for t in range(len(self.active) - 1, -1, -1):
            yield t, self.begin[t], self.begin[t + 1]

    def restore(self, laid: np.ndarray) -> np.ndarray:
        """Values in layout order, back in document order."""
        out = np.empty_like(laid)
        out[self.order] = laid
        return out


def groups(batches: Iterable[pa.RecordBatch], key: int = 0, text: int = 1) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Keys and words of documents, longest first, some hundred thousand words at a time."""
    for batch in batches:
        keys, texts = batch.column(key).to_pylist(), batch.column(text)
        sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts], np.int64)
        keys_out, words_out, total = [], [], 0
        for i in np.argsort(-sizes, kind="stable"):
            words = (texts[int(i)].as_py() or b"").split()
            if keys_out and total + len(words) > GROUP_WORDS:
                yield _longest_first(keys_out, words_out)
                keys_out, words_out, total = [], [], 0
            keys_out.append(keys[i])
            words_out.append(words)
            total += len(words)
        if keys_out:
            yield _longest_first(keys_out, words_out)


def _longest_first(keys: list, words: list[list[bytes]]) -> tuple[list, list[list[bytes]]]:
    order = sorted(range(len(keys)), key=lambda i: -len(words[i]))
    return [keys[i] for i in order], [words[i] for i in order]


def flat(words: list[list[bytes]]) -> list[bytes]:
    return [w for doc in words for w in doc]
