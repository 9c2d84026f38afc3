"""Approximate nearest neighbours by multi-index hashing.

A rotation (principal directions, then iterative quantisation) fitted on a bounded
sample turns every vector into a binary code. A shard splits its codes into substrings
of eight bits and indexes each. If two codes of m substrings differ in fewer than
m (p + 1) bits, some substring differs in p bits or fewer; so looking up all values
within p bits of a query's substrings finds every code within that radius. p grows
until the radius holds ``enough`` rows of the shard, then the found rows are ranked by
the exact Euclidean distance in double precision.

``SAMPLE`` rows at most (in expectation) fit the rotation of each vector length; every
row is indexed. Recall is measured in the tests against brute force.

Results for odd input: rows with a null id, and null, zero, empty or non-finite vectors
take no part; an id in several rows counts once, with its nearest row, and is never
its own neighbour; ties go to the smaller id; equal vectors share a code and are all
found together; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm import shards

SAMPLE, BITS, PART = 10_000, 64, 8
ENOUGH = 400

#: All values of a substring by the number of bits set: XOR masks of radius 0, 1, 2, ...
_ONES = np.array([v.bit_count() for v in range(1 << PART)])
MASKS = [np.flatnonzero(_ONES <= p) for p in range(PART + 1)]


class Rotation:
    """Centre and axes of one vector length; bit i is the sign along axis i."""

    def __init__(self, sample: np.ndarray, rounds: int = 25) -> None:
        self.centre = sample.mean(axis=0)
        data = sample - self.centre
        bits = min(BITS, data.shape[1])
        _, axes = np.linalg.eigh(data.T @ data)
        axes = axes[:, ::-1][:, :bits]
        flat = data @ axes
        turn = np.linalg.qr(np.random.default_rng(7).normal(size=(bits, bits)))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        self.axes = axes @ turn

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """Substrings of the codes: rows x parts, as small numbers."""
        return np.packbits((rows - self.centre) @ self.axes >= 0, axis=1)


def fit(vectors: DataFrame, sample: int = SAMPLE) -> dict[int, Rotation]:
    rows = vectors.count()
    draw = F.pmod(F.xxhash64(F.lit("rotation"), "vec_id"), F.lit(1 << 30)) < int(sample / max(rows, 1) * (1 << 30))
    by_size: dict[int, list] = {}
    for row in vectors.where(draw).orderBy("vec_id").toLocalIterator():
        by_size.setdefault(len(row["embedding"]), []).append(row["embedding"])
    return {size: Rotation(np.array(found, np.float64)) for size, found in by_size.items()}


def index(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by substring value, all parts one after the other, and where each value begins."""
    order = np.argsort(codes, axis=0, kind="stable").T
    begins = np.stack([np.searchsorted(codes[o, j], np.arange((1 << PART) + 1)) for j, o in enumerate(order)])
    return order.ravel(), begins + np.arange(len(order))[:, None] * codes.shape[0]


def within(code: np.ndarray, codes: np.ndarray, rows: np.ndarray, begins: np.ndarray, enough: int) -> np.ndarray:
    """All rows whose code lies in the smallest probed radius that holds ``enough`` rows."""
    parts = len(code)
    for p in range(PART + 1):
        probes = code[:, None] ^ MASKS[p]
        first = np.take_along_axis(begins, probes, 1).ravel()
        sizes = np.take_along_axis(begins, probes + 1, 1).ravel() - first
        ends = np.cumsum(sizes)
        found = np.unique(rows[np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)])
        far = _ONES[codes[found] ^ code.astype(np.uint8)].sum(axis=1)
        found = found[far < parts * (p + 1)]
        if len(found) >= enough:
            break
    return found


def search(vectors: DataFrame, is_query: Column, k: int = 10, enough: int = ENOUGH) -> DataFrame:
    """query_id, rank, vec_id, score (distance): the k nearest rows found for every query."""
    vectors = shards.usable(vectors, zeros=False)
    rotations = fit(vectors)

    def best(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray) -> list[tuple]:
        # A length that the sample missed is rare; its shard fits its own.
        rotation = rotations.get(rows.shape[1]) or Rotation(rows)
        codes = rotation.codes(rows)
        listed, begins = index(codes)
        most = int(np.unique(ids, return_counts=True)[1].max())  # rows of one id take up places
        out = []
        for query, vector, code in zip(query_ids, queries, rotation.codes(queries).astype(np.int64), strict=True):
            found = within(code, codes, listed, begins, enough + 1)
            found = found[ids[found] != query]
            far = rows[found] - vector
            far = np.sqrt((far * far).sum(axis=1))
            for i in np.lexsort((ids[found], far))[:k * most]:
                out.append((query, ids[found[i]], far[i]))
        return out

    return shards.search(vectors, is_query, best, "double", k, nearest=True)
