"""Token counts of whole texts under a byte-level BPE tokenizer, without encoding most words.

Offline, every string of the vocabulary is given to the merges alone; those that come out
as one token are *whole*. A text is cut into pre-tokens by the tokenizer's own pattern; a
whole pre-token counts one at once, and only the rest is merged. A pre-token's count is
independent of its neighbours, so it is kept for the next text.

The pattern runs in another regular expression engine than the tokenizer's, and the two may
know different versions of Unicode. Before a block of 256 code points is trusted, both
engines cut a probe text that shows whether each of them is a letter, a number, white space
or none of these; a text with a code point they disagree on is encoded by the library.

Strings of added tokens inside a text are one token each, as is the library's default.

Results for odd input: a null text counts as an empty one, of no bytes and no tokens; bytes
that are not UTF-8 count as bytes and are read as U+FFFD for tokens; rows with equal ids
are counted each for themselves; an empty table gives an empty one. A text is cut between
a character and the white space after it every ``CHUNK`` characters, which changes no
pre-token, so a very long text costs little more memory than itself. Other columns of the
input are not carried, whatever their names.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import batch, raw_text, rows_of

COUNTS = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
])
# Fixed value: how a byte-level tokenizer cuts a text before its merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text that are cut into pre-tokens at once.
CHUNK = 1 << 20
#: Counts of merged pre-tokens a worker keeps, and the longest pre-token kept.
MERGED_KEPT, LONGEST_KEPT = 400_000, 100
BLOCK = 256

_counters: dict[str, TokenCounter] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _refuse_unknown_form(described: dict) -> None:
    model, cut = described["model"], described.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and not model.get("dropout")
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        and described.get("normalizer") is None and cut.get("type") == "ByteLevel"
        and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    )
    marked = any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in described["added_tokens"])
    if not plain or marked:
        raise ValueError("Counts need a plain byte-level BPE tokenizer")


class TokenCounter:
    """Numbers of tokens of texts, from whole pre-tokens and kept merges."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            described = json.load(source)
        _refuse_unknown_form(described)
        self.tokenizer = Tokenizer.from_file(path)
        # Padding and truncation would change the counts of the texts given to the library.
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.characters = byte_characters()
        added = sorted((t["content"] for t in described["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern = regex.compile(PATTERN)
        self.gap = regex.compile(r"\S(?=\s)")
        self.whole = self._prove(described["model"]["vocab"])
        self.counts = _Counts(self)
        self._agreed: dict[int, frozenset[str]] = {}

    def _prove(self, vocabulary: Iterable[str]) -> frozenset[str]:
        """The texts that the merges leave as one token."""
        of = {c: b for b, c in enumerate(self.characters)}
        proven = set()
        for token in vocabulary:
            if len(self.tokenizer.model.tokenize(token)) == 1 and all(c in of for c in token):
                try:
                    proven.add(bytes(of[c] for c in token).decode())
                except UnicodeDecodeError:
                    pass  # part of a character: never a pre-token
        return frozenset(proven)

    def merge(self, piece: str) -> int:
        """Tokens of a pre-token, by the merges."""
        return len(self.tokenizer.model.tokenize("".join([self.characters[b] for b in piece.encode()])))

    def _disagreed(self, block: int) -> frozenset[str]:
        """The code points of a block that the two engines put into different classes."""
        if block not in self._agreed:
            points = range(block * BLOCK, (block + 1) * BLOCK)
            found = set()
            for c in (chr(p) for p in points if not 0xD800 <= p < 0xE000):
                probe = f"a{c}a1{c}1!{c}!  {c}\n"
                ours = [m.span() for m in self.pattern.finditer(probe)]
                theirs = [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
                if ours != theirs:
                    found.add(c)
            self._agreed[block] = frozenset(found)
        return self._agreed[block]

    def _trusted(self, text: str) -> bool:
        if text.isascii():
            return not self._disagreed(0)
        characters = set(text)
        blocks = {ord(c) // BLOCK for c in characters}
        return not any(self._disagreed(b) & characters for b in blocks)

    def _chunks(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > CHUNK and (gap := self.gap.search(text, at + CHUNK)):
            yield text[at:gap.end()]
            at = gap.end()
        yield text[at:] if at else text

    def __call__(self, text: str) -> int:
        if not self._trusted(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.added.split(text) if self.added else [text]
        total = len(parts) - 1
        for part in parts:
            for chunk in self._chunks(part):
                total += sum(map(self.counts.__getitem__, self.pattern.findall(chunk)))
        return total


class _Counts(dict):
    """Tokens by pre-token: whole ones from the start, others once they were merged."""

    def __init__(self, counter: TokenCounter) -> None:
        super().__init__(dict.fromkeys(counter.whole, 1))
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        found = self.counter.merge(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) > MERGED_KEPT + len(self.counter.whole):
                self.clear()
                self.update(dict.fromkeys(self.counter.whole, 1))
            self[piece] = found
        return found


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def counter(path: str | None = None) -> TokenCounter:
    """The worker's counter for a tokenizer file; its proofs are made once."""
    path = path or tokenizer_path()
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count(
    documents: DataFrame, limit: int = 512, tokenizer: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, and over_limit: more tokens than ``limit``."""
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(tokenizer)
        for rows in batches:
            out = []
            for doc, text in rows_of([rows]):
                raw = text or b""
                out.append((doc, len(raw), of(raw.decode("utf-8", "replace"))))
            if out:
                yield batch(COUNTS, list(zip(*out, strict=True)))

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col).alias("text"))
    found = rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
