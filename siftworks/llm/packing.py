"""Best-fit packing of documents into fixed-length sequences by sums of squares.

Documents become pieces of at most ``capacity`` tokens; only longer documents are
cut. A piece goes where the sum over all gaps of (open bins with that gap) squared
becomes smallest; ties go to the tightest bin, and a new bin is opened only if that
is better than every open one. Pieces come in falling length, so that short ones
fill what long ones leave. Groups of some ten million tokens are packed
independently, one task each; the number of groups grows with the tokens, and a
group wastes at most its few last bins.

Token ids come from a public tokenizer whose words never span white space, so each
distinct word is encoded once per worker and documents are joined from these. A new word
is put together from its parts, of which there are far fewer than words.

Results for odd input: a null or empty text is one piece of one token (the end
mark); rows with equal ids are packed as rows of their own; an empty table gives an
empty one; very long texts are cut and hold one document's tokens in memory.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import batch, raw_text, rows_of
from siftworks.llm.tokencounts import byte_characters
from siftworks.staging import Staging

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()),
])
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

#: Encoded words, and parts of words, kept by a worker: those of late and, of equal number, those before them.
WORDS_KEPT, PARTS_KEPT = 350_000, 250_000
_encoders: dict[str, Encoder] = {}
# Words of printable ASCII and accented Latin letters only: their case and parts are the same everywhere.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# Fixed value: how the tokenizer cuts such a word, in lower case, before its merges.
_PARTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_SPECIAL = b"<|"


class Kept(dict):
    """A dictionary that makes what it lacks, and forgets what was not used for long."""

    def __init__(self, make: Callable, most: int) -> None:
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()
        found = self.before.get(key)
        self[key] = found = self.make(key) if found is None else found
        return found


class Encoder:
    """Ids of whole texts, little-endian, from kept words, which are put together from kept parts.

    A word that is not plain, or may hold a special token, is encoded whole by the library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.characters = byte_characters()
        self.parts = Kept(self._part, PARTS_KEPT)
        self.words = Kept(self._word, WORDS_KEPT)

    def _part(self, part: str) -> bytes:
        shown = part if part.isascii() else "".join([self.characters[b] for b in part.encode()])
        return pack_ids([token.id for token in self.tokenizer.model.tokenize(shown)])

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _SPECIAL not in word and _PLAIN.fullmatch(text):
            parts = self.parts
            return b"".join([parts[p] for p in _PARTS.findall(text.lower())])
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: bytes) -> bytes:
        return b"".join(list(map(self.words.__getitem__, text.split())))


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack_ids(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(
    documents: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Cut documents into pieces: doc_id, piece, start, length, ids_crc32."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or tokenizer_path())
        out: list[tuple] = []
        for doc, text in rows_of(batches):
            ids = encode(text or b"") + end
            for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                out.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part)))
            if len(out) >= 10_000:
                yield batch(PIECES, list(zip(*out, strict=True)))
                out = []
        if out:
            yield batch(PIECES, list(zip(*out, strict=True)))

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col)).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: Iterable[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, taken in the given order."""
    counts = np.zeros(capacity + 1, np.int64)  # open bins by gap; 0 and capacity stay 0
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened, where, offsets = 0, [], []
    for size in lengths:
        fresh = 2 * counts[capacity - size] + 1 if size < capacity else 0
        # Change of the sum when a bin with gap g takes the piece, for g = size, size + 1, ...
        change = 2 * (counts[:capacity - size + 1] - counts[size:]) + 2
        change[0] = 1 - 2 * counts[size]
        change[counts[size:] == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        if change[best] <= fresh:
            gap = size + best
            bin_ = bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, bin_ = capacity, opened
            opened += 1
        where.append(bin_)
        offsets.append(capacity - gap)
        if gap > size:
            bins[gap - size].append(bin_)
            counts[gap - size] += 1
    return where, offsets


def pack(cut: DataFrame, capacity: int = 4096, group_tokens: int = 1 << 25) -> DataFrame:
    """Give each piece a sequence and its offset there."""
    stage = Staging(cut.sparkSession).write(cut, "pieces", tokens=F.sum("length"))
    groups = max(1, -(-(stage.metrics.get("tokens") or 0) // group_tokens))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("piece", "ascending"), ("ids_crc32", "ascending")])
        where, offsets = sum_of_squares(table["length"].to_pylist(), capacity)
        group = table["_group"][0].as_py() if len(table) else 0
        return table.drop_columns(["_group"]).append_column(
            "sequence_id", pa.array([(group << 36) + w for w in where], pa.int64())
        ).append_column("offset", pa.array(offsets, pa.int64()))

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    # Dealt by range: hashing few group numbers would put several into one task.
    return stage.frame.withColumn("_group", group).groupBy("_group").applyInArrow(place, PACKED)
