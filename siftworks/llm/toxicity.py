"""Toxic spans from a linear-chain conditional random field.

Labels mark documents; tokens are labelled from them. A word, or a four-letter part of
one, that toxic sample documents use far more often than clean ones (ratio and
likelihood-ratio test) marks a token of a toxic document as toxic. A two-state chain
with weights for such words and parts, and for the transitions, is fitted to these
tokens by maximum likelihood. For every whole text forward-backward gives each word's
marginal; the largest one and their sum give the document's score through a logistic
curve fitted on the sample, and runs of words above one half are the offending spans.

The sample is bounded: ``SAMPLE`` documents of each class, chosen by a hash of their
id, of at most ``LONGEST`` bytes each (longer ones are scored whole, but not learnt
from). Nothing else is sampled.

Results for odd input: null and empty texts get the score of a text without toxic
words; without any toxic or clean label every score is 0; a label row with a null id
or label is ignored and of several rows for an id the largest label holds; equal texts
score alike; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.chains import Letters, Steps, Words, flat, groups, mixed
from siftworks.llm.common import raw_text

SAMPLE, LONGEST = 2_000, 100_000

SCORED = pa.schema([
    ("doc_id", pa.int64()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32())]))),
])


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word's letters and of its four-letter parts, and whose they are."""
    letters = Letters(words)
    some = np.flatnonzero(letters.counts)
    ahead = [letters.shifted(i) for i in (1, 2, 3)]
    whole = np.flatnonzero(ahead[2])
    part = letters.code[whole]
    for other in ahead:
        part = mixed(part + np.uint64(1)) + other[whole]
    return (np.concatenate([letters.hashes()[some], mixed(part)]),
            np.concatenate([some, letters.word[whole]]))


def marginals(emission: np.ndarray, steps: Steps, trans: np.ndarray) -> tuple[np.ndarray, ...]:
    """P(toxic) of each word (document order); expected transitions (2 x 2, summed).

    Written in odds: forward odds f_t = e_t (t01 + f t11) / (t00 + f t10), and the same
    backwards, so that no value under- or overflows on long texts.
    """
    gain = np.exp(np.clip(emission[steps.order], -30, 30))
    (t00, t01), (t10, t11) = np.exp(trans)
    ahead, behind = np.empty_like(gain), np.empty_like(gain)
    odds = np.ones(len(steps.lengths))
    for t, a, b in steps.forward():
        now = odds[:b - a]
        if t:
            now[:] = (t01 + now * t11) / (t00 + now * t10)
        now *= gain[a:b]
        ahead[a:b] = now
    back = np.ones(len(steps.lengths))
    expected = np.zeros((2, 2))
    last = None
    for t, a, b in steps.backward():
        behind[a:b] = back[:b - a]
        if t:
            through = gain[a:b] * back[:b - a]
            # Joint odds of the pair (t - 1, t).
            left = ahead[steps.begin[t - 1]:steps.begin[t - 1] + b - a]
            pair = np.array([[t00 + 0 * left, t01 * through], [left * t10, left * t11 * through]])
            expected += (pair / pair.sum(axis=(0, 1))).sum(axis=2)
            back[:b - a] = (t10 + t11 * through) / (t00 + t01 * through)
        last = b
    product = ahead * behind
    return steps.restore(product / (1 + product)), expected, last


class Tagger:
    """Feature weights, transitions and the curve from marginals to a score."""

    def __init__(self) -> None:
        self.names, self.weights = np.zeros(0, np.uint64), np.zeros(0)
        self.bias = -6.0
        self.trans = np.zeros((2, 2))
        self.curve = np.zeros(3)
        self.fitted = False

    def emission(self, words: list[bytes]) -> np.ndarray:
        """The log odds each word has by itself, as a column."""
        names, owner = features(words)
        weight = np.zeros(len(names))
        if len(self.names):
            row = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            weight = np.where(self.names[row] == names, self.weights[row], 0)
        return (self.bias + np.bincount(owner, weight, len(words)))[:, None]

    def tokens(self, table: Words, words: list[list[bytes]]) -> np.ndarray:
        lengths = np.array([len(w) for w in words], np.int64)
        emission = table.take(flat(words))[:, 0].astype(np.float64)
        return marginals(emission, Steps(lengths), self.trans)[0]

    def summary(self, p: np.ndarray) -> np.ndarray:
        most = np.clip(p.max(initial=1e-9), 1e-9, 1 - 1e-9)
        return np.array([1.0, np.log(most / (1 - most)), np.log1p(p[p > 0.5].sum())])

    def score(self, p: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.summary(p) @ self.curve, -40, 40)))) if self.fitted else 0.0


def _g2(a: np.ndarray, b: np.ndarray, na: float, nb: float) -> np.ndarray:
    """Likelihood ratio statistic of two Poisson rates."""
    both = (a + b) / (na + nb)
    part = lambda k, n: np.where(k > 0, k * np.log(np.maximum(k, 1) / np.maximum(n * both, 1e-12)), 0)
    return 2 * (part(a, na) + part(b, nb))


def train(texts: list[tuple[bytes, int]], rounds: int = 60) -> Tagger:
    """Fit a tagger on (text, label) pairs."""
    tagger = Tagger()
    texts = sorted(texts, key=lambda row: (-len(row[0].split()), row[0], row[1]))
    labels = np.array([y for _, y in texts], np.int64)
    if not len(labels) or labels.min() == labels.max():
        return tagger
    docs = [t.split() for t, _ in texts]
    lengths = np.array([len(d) for d in docs], np.int64)
    numbers: dict[bytes, int] = {}
    tokens = np.fromiter((numbers.setdefault(w, len(numbers)) for d in docs for w in d), np.int64, lengths.sum())
    owner = np.repeat(np.arange(len(docs)), lengths)
    hashes, part_word = features(list(numbers))
    names, flat_parts = np.unique(hashes, return_inverse=True)
    # In how many (document, distinct word) pairs of each class a feature occurs.
    pair = np.unique(owner * len(numbers) + tokens)
    toxic_pair = labels[pair // len(numbers)] == 1
    per_word = [np.bincount((pair % len(numbers))[k], minlength=len(numbers)) for k in (toxic_pair, ~toxic_pair)]
    seen_toxic, seen_clean = (np.bincount(flat_parts, c[part_word], len(names)) for c in per_word)
    n_toxic, n_clean = (max(float(c.sum()), 1.0) for c in per_word)
    ratio = ((seen_toxic + 0.5) / n_toxic) / ((seen_clean + 0.5) / n_clean)
    test = _g2(seen_toxic, seen_clean, n_toxic, n_clean)
    marker = (ratio >= 5) & (test >= 20)
    used = marker | (test >= 12)
    column = np.cumsum(used) - 1
    marked_word = np.bincount(part_word, marker[flat_parts], len(numbers)) > 0
    y = (marked_word[tokens] & (labels[owner] == 1)).astype(np.float64)
    # Toxic documents without a marked word say nothing about their tokens.
    clear = (labels == 0) | (np.bincount(owner, y, len(docs)) > 0)
    keep = clear[owner]
    tokens, y, steps = tokens[keep], y[keep], Steps(lengths[clear])
    inside = used[flat_parts]
    fp, fw = column[flat_parts[inside]], part_word[inside]
    weights = np.zeros(int(used.sum()) + 1)
    weights[-1] = tagger.bias
    trans = np.zeros((2, 2))
    first = np.zeros(len(y), bool)
    own_lengths = lengths[clear]
    first[(np.cumsum(own_lengths) - own_lengths)[own_lengths > 0]] = True
    follows = np.flatnonzero(~first)
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[follows - 1].astype(int), y[follows].astype(int)), 1)
    seen = np.bincount(tokens, y, len(numbers))
    moment, square = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for k in range(1, rounds + 1):
        word_score = np.bincount(fw, weights[fp], len(numbers)) + weights[-1]
        p, expected, _ = marginals(word_score[tokens], steps, trans)
        rest = seen - np.bincount(tokens, p, len(numbers))
        slope = np.concatenate([np.bincount(fp, rest[fw], len(weights) - 1), [rest.sum()], (observed - expected).ravel()])
        slope[:-4] -= 0.1 * weights * (np.arange(len(weights)) < len(weights) - 1)
        slope[-4:] -= 0.1 * trans.ravel()
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        move = 0.3 * (moment / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-8)
        weights += move[:-4]
        trans = trans + move[-4:].reshape(2, 2)
    tagger.names, tagger.weights = names[used], weights[:-1].copy()
    tagger.bias, tagger.trans, tagger.fitted = float(weights[-1]), trans, True
    word_score = np.bincount(fw, weights[fp], len(numbers)) + weights[-1]
    every = np.fromiter((numbers[w] for d in docs for w in d), np.int64, lengths.sum())
    p = marginals(word_score[every], Steps(lengths), trans)[0]
    ends = np.cumsum(lengths)
    x = np.array([tagger.summary(p[e - n:e]) for n, e in zip(lengths, ends, strict=True)])
    tagger.curve = _logistic(x, labels)
    return tagger


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton's method; the penalty keeps separable classes finite."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(beta))
        beta = beta + np.linalg.solve(hessian, x.T @ (y - p) - penalty * beta)
    return beta


def fit(documents: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Tagger:
    """Learn from a bounded sample of the label rows for which ``learn`` (over doc_id) holds."""
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(learn)
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    )
    sizes = {row["_toxic"]: row["count"] for row in marks.groupBy("_toxic").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for value, n in sizes.items():
        chosen = chosen | ((F.col("_toxic") == value) & (draw < int(sample / n * (1 << 30))))
    # About 2 x sample narrow rows by construction, so the texts need no shuffle.
    rows = (
        documents.select("doc_id", raw_text().alias("text")).where(F.length("text") <= LONGEST)
        .join(F.broadcast(marks.where(chosen)), F.col("doc_id") == F.col("_id"))
        .select("text", "_toxic").distinct()
    )
    return train([(bytes(r["text"]), r["_toxic"]) for r in rows.toLocalIterator()])


def score(documents: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, spans (first and last offending word) of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Words(tagger.emission, 1)
        for ids, words in groups(batches):
            p = tagger.tokens(table, words)
            ends = np.cumsum([len(w) for w in words])
            scores, spans = [], []
            for w, end in zip(words, ends, strict=True):
                own = p[end - len(w):end]
                scores.append(tagger.score(own))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own > 0.5, [0]]).astype(np.int8)))
                spans.append([{"first_word": int(f), "last_word": int(z) - 1} for f, z in zip(edges[::2], edges[1::2], strict=True)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip((ids, scores, spans), SCORED, strict=True)], schema=SCORED)

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col)).mapInArrow(
        run, "doc_id long, score double, spans array<struct<first_word:int,last_word:int>>")
