"""Language ID: script ranges, per-word scores, and Viterbi with a switching penalty.

A model is fitted on a bounded sample of labelled documents: word and letter-trigram
counts by language, and the scripts each language uses. A word's script keeps only
languages written in it; the rest score it by smoothed log likelihood. Viterbi then
labels every word of the whole text, where a change of language costs ``switch``, so
spans of mixed text are told apart. A document's language is the one with most
lettered words (ties: smaller code point), its score that share.

Results for odd input: a null, empty or letterless text is ``und`` with score 0; so is
every text when there is no labelled row; equal rows get equal answers; very long
texts are labelled whole; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.chains import Letters, Steps, Words, flat, groups, mixed
from siftworks.llm.common import raw_text, rows_of, staged

UNKNOWN = "und"
#: Documents the model is fitted on, and the words and trigrams it keeps.
SAMPLE, VOCABULARY = 20_000, 60_000

#: First code points of letter ranges of the Unicode blocks.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
)
_BEGINS = np.array([begin for begin, _ in SCRIPTS])
#: Trigrams are counted in this many hash classes.
GRAMS = 1 << 18

LABELLED = pa.schema([
    ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string())]))),
])


def grams(letters: Letters) -> np.ndarray:
    """The class of the trigram around every letter; 0 stands beyond a word's ends."""
    around = letters.shifted(-1) * np.uint64(1 << 42) + letters.code * np.uint64(1 << 21) + letters.shifted(1)
    return (mixed(around) % np.uint64(GRAMS)).astype(np.int64)


def scripts(letters: Letters) -> np.ndarray:
    """The script range of every word's first letter; -1 without letters."""
    out = np.full(letters.words, -1)
    first = letters.at == 0
    out[letters.word[first]] = np.searchsorted(_BEGINS, letters.code[first].astype(np.int64), "right") - 1
    return out


class Model:
    """Scores words in every language."""

    def __init__(self, counts: Iterable[tuple[str, str, int, int]]) -> None:
        counts = list(counts)
        self.langs = sorted({lang for lang, *_ in counts})
        at = {lang: i for i, lang in enumerate(self.langs)}
        width = len(self.langs)
        words = sorted({key for _, kind, key, _ in counts if kind == "word"})
        self.words = np.array(words, np.int64)
        place = {key: i for i, key in enumerate(words)}
        word, gram = np.zeros((len(words), width)), np.zeros((GRAMS, width))
        script = np.zeros((len(SCRIPTS), width))
        for lang, kind, key, n in counts:
            table, row = {"word": (word, place.get(key)), "gram": (gram, key), "script": (script, key)}[kind]
            table[row, at[lang]] += n
        log = lambda t: np.log((t + 0.5) / (t.sum(axis=0) + 0.5 * ((t.sum(axis=1) > 0).sum() + 1)))
        self.word, self.gram = log(word), log(gram).astype(np.float32)
        # A language is written in the scripts that hold a hundredth of its words; ranges of one name are one script.
        names = np.array([name for _, name in SCRIPTS])
        for name in set(names):
            script[names == name] = script[names == name].sum(axis=0)
        self.able = script >= 0.01 * np.maximum(word.sum(axis=0), 1)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """Scores from 0 (best) down to -10 by language, then 1 for lettered words."""
        letters = Letters(words)
        out = np.zeros((len(words), len(self.langs) + 1))
        found = grams(letters)
        for i in range(len(self.langs)):
            out[:, i] = 0.5 * np.bincount(letters.word, self.gram[found, i], len(words))
        hashes = letters.hashes().view(np.int64)
        if len(self.words):
            row = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            out[:, :-1] += np.where((self.words[row] == hashes)[:, None], self.word[row], 0)
        script = scripts(letters)
        able = self.able[script]
        able[~able.any(axis=1)] = True  # no language has this script: all are equal
        out[:, :-1] = np.where(able, out[:, :-1], -np.inf)
        out[:, :-1] = np.maximum(out[:, :-1] - out[:, :-1].max(axis=1, keepdims=True, initial=-1e300), -10)
        out[(script < 0) | ~self.able[script].any(axis=1), :-1] = 0
        out[:, -1] = letters.counts > 0
        return out


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, trigrams and scripts by language, summed over a task's documents."""
    by_lang: dict[str, Counter] = defaultdict(Counter)
    for lang, text in rows_of(batches):
        by_lang[lang].update(text.split())
    for lang, words in by_lang.items():
        letters = Letters(list(words))
        n = np.fromiter(words.values(), np.int64, len(words))
        lettered = letters.counts > 0
        for kind, keys, weight in (
            ("word", letters.hashes().view(np.int64)[lettered], n[lettered]),
            ("gram", grams(letters), n[letters.word]),
            ("script", scripts(letters)[lettered], n[lettered]),
        ):
            if len(keys):
                key, inverse = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(key), pa.string()),
                    "kind": pa.array([kind] * len(key), pa.string()),
                    "key": pa.array(key.astype(np.int64)),
                    "n": pa.array(np.bincount(inverse, weight).astype(np.int64)),
                })


def fit(
    labelled: DataFrame, key: Column, sample: int = SAMPLE, vocabulary: int = VOCABULARY,
    lang_col: str = "lang", text_col: str = "text",
) -> Model:
    """Fit on about ``sample`` of the labelled rows, chosen by a hash of ``key``."""
    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = labelled.select(F.lit(1)).count()
    share = F.pmod(F.xxhash64(F.lit("language"), key), F.lit(1 << 30)) < int(sample / max(rows, 1) * (1 << 30))
    counts = (
        labelled.where(share).select(F.col(lang_col).alias("lang"), raw_text(text_col).alias("text"))
        .mapInArrow(_count, "lang string, kind string, key long, n long")
        .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    )
    counts = staged(counts, "counts")
    # Classes of trigrams and scripts are of a fixed number; words are the frequent ones.
    found = counts.where("kind <> 'word'").collect() + (
        counts.where("kind = 'word'").orderBy(F.desc("n"), "lang", "key").limit(vocabulary).collect())
    return Model(found)


def viterbi(scores: np.ndarray, steps: Steps, switch: float) -> np.ndarray:
    """The best language of every word; ``scores`` and the result are in document order."""
    laid = scores[steps.order]
    docs = len(steps.lengths)
    value = np.zeros((docs, scores.shape[1]), np.float64)
    best = np.zeros(len(laid), np.int16)
    stays = np.zeros(laid.shape, bool)
    for t, a, b in steps.forward():
        now = value[:b - a]
        if t:
            top = now.argmax(axis=1)
            best[a:b] = top
            most = now[np.arange(b - a), top][:, None] - switch
            stays[a:b] = now >= most
            np.maximum(now, most, out=now)
        now += laid[a:b]
    state = value.argmax(axis=1)
    path = np.zeros(len(laid), np.int16)
    for t, a, b in steps.backward():
        now = state[:b - a]
        path[a:b] = now
        if t:
            np.copyto(now, best[a:b], where=~stays[a:b][np.arange(b - a), now])
    return steps.restore(path)


class Labeller:
    """Language, score and spans of whole texts."""

    def __init__(self, model: Model, switch: float) -> None:
        self.langs = np.array([*model.langs, UNKNOWN], dtype=object)
        self.table, self.switch = Words(model, len(self.langs)), switch

    def __call__(self, batch: pa.RecordBatch) -> Iterator[tuple[list, list[tuple]]]:
        """Keys (first column) and (language, score, path) of texts (second column), some at a time."""
        width = len(self.langs) - 1
        for keys, words in groups([batch]):
            lengths = np.array([len(w) for w in words], np.int64)
            rows = self.table.take(flat(words))
            path = viterbi(rows[:, :-1], Steps(lengths), self.switch) if width else np.zeros(len(rows), np.int16)
            answers = []
            for n, end in zip(lengths, np.cumsum(lengths), strict=True):
                own, lettered = path[end - n:end], rows[end - n:end, -1] > 0
                if not width or not lettered.any():
                    answers.append((UNKNOWN, 0.0, own[:0]))
                    continue
                counts = np.bincount(own[lettered], minlength=width)
                answers.append((self.langs[counts.argmax()], float(counts.max() / counts.sum()), own))
            yield keys, answers

    def spans(self, path: np.ndarray) -> list[dict]:
        cuts = np.flatnonzero(np.diff(path)) + 1
        first, last = [0, *cuts.tolist()], [*(cuts - 1).tolist(), len(path) - 1]
        return [{"first_word": f, "last_word": z, "lang": self.langs[path[f]]}
                for f, z in zip(first, last, strict=True)] if len(path) else []


def label(
    documents: DataFrame, model: Model, switch: float = 6.0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, lang_pred, score, spans (first and last word, language) of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, switch)
        for batch in batches:
            for keys, answers in labeller(batch):
                langs, scores, paths = zip(*answers, strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, t.type) for c, t in
                    zip((keys, langs, scores, map(labeller.spans, paths)), LABELLED, strict=True)], schema=LABELLED)

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col)).mapInArrow(
        run, "doc_id long, lang_pred string, score double,"
        " spans array<struct<first_word:int,last_word:int,lang:string>>")


def keep_known(documents: DataFrame, model: Model, switch: float = 6.0, text_col: str = "text") -> DataFrame:
    """The rows whose text is in some language, unchanged, whatever the names of their columns."""
    names = documents.columns
    at = names.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, switch)
        for batch in batches:
            known = np.zeros(len(batch), bool)
            text = batch.column(at).cast(pa.binary())
            numbered = pa.RecordBatch.from_arrays([pa.array(range(len(batch)), pa.int64()), text], names=["row", "text"])
            for keys, answers in labeller(numbered):
                known[keys] = [lang != UNKNOWN for lang, _, _ in answers]
            yield batch.filter(pa.array(known))

    # Columns are numbered on the way, since a name may hold dots.
    numbered_rows = documents.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered_rows.mapInArrow(run, numbered_rows.schema).toDF(*names)
