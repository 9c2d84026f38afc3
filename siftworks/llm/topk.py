"""Exact top-k inner products with the bounds of MaxScore, over shards.

Vectors are made whole numbers, ``floor(scale * x)``. A component is a term; a shard
keeps a posting row per term with its smallest and largest value, which bound what the
term can add to any score of a query. Terms are taken by falling spread of their
bounds. The first ``STEP`` are traversed for every row (no split of terms is made by whether
the sum of their bounds could pass the threshold); then the k-th best sum of what
is surely reached is a threshold, and only rows whose sum plus the bounds of the other
terms can still reach it are probed further, a block of terms at a time. Each shard
returns its exact k best, which are merged.

Results for odd input: rows with a null id and null, empty or non-finite vectors take
no part; zero vectors do; ties go to the smaller id, so rows that only equal the threshold
stay competitive; an id in several rows counts once, with its best row, and is never
its own candidate; an empty table gives an empty one. Scores beyond 64 bits are cut to
the range.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from siftworks.llm import shards

STEP = 16


def whole(rows: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): exact in doubles while all sums of products are, else as Python numbers."""
    numbers = np.floor(rows * scale)
    if len(numbers) and np.abs(numbers).max() ** 2 * numbers.shape[1] >= 2.0 ** 53:
        return np.array([[int(x) for x in row] for row in numbers], dtype=object)
    return numbers


def maxscore(postings: np.ndarray, low: np.ndarray, high: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may be among the k best, with their exact scores. postings: terms x rows."""
    ends = np.stack([query * low, query * high])
    least, most = ends.min(axis=0), ends.max(axis=0)
    terms = np.argsort(-(most - least), kind="stable")
    rest_least = np.concatenate([np.cumsum(least[terms][::-1])[::-1], [0]])
    rest_most = np.concatenate([np.cumsum(most[terms][::-1])[::-1], [0]])
    rows, sums = None, None
    for at in range(0, len(terms), STEP):
        block = terms[at:at + STEP]
        if rows is None:
            sums = query[block] @ postings[block]
            rows = np.arange(postings.shape[1])
        else:
            sums = sums + query[block] @ postings[np.ix_(block, rows)]
        done = min(at + STEP, len(terms))
        if len(rows) > k:
            threshold = np.partition(sums, len(sums) - k)[-k] + rest_least[done]
            able = sums + rest_most[done] >= threshold
            rows, sums = rows[able], sums[able]
    return rows, sums


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query."""

    def best(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray) -> list[tuple]:
        numbers = whole(np.concatenate([rows, queries]), scale)
        rows, queries = numbers[:len(rows)], numbers[len(rows):]
        # Rows of one id, the query's own among them, may take up places.
        most = int(np.unique(ids, return_counts=True)[1].max())
        postings = np.ascontiguousarray(rows.T)
        low, high = rows.min(axis=0), rows.max(axis=0)
        out = []
        for query, vector in zip(query_ids, queries, strict=True):
            found, scores = maxscore(postings, low, high, vector, min(len(ids), (k + 1) * most))
            other = ids[found] != query
            found, scores = found[other], scores[other]
            order = np.lexsort((ids[found], -scores)) if scores.dtype != object else np.array(
                sorted(range(len(found)), key=lambda i: (-scores[i], ids[found[i]])), np.int64)
            for i in order[:k * most]:
                out.append((query, ids[found[i]], max(-2**63, min(2**63 - 1, int(scores[i])))))
        return out

    return shards.search(shards.usable(vectors, zeros=True), is_query, best, "long", k, nearest=False)
