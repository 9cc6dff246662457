"""Approximate nearest neighbours by a hash-prefix forest (LSH forest), Euclidean distance.

A shard of rows holds ``trees`` sorted arrays of long hash strings, one bit per random
hyperplane through the shard's mean.  A query descends in every array to its longest
matching prefix; then all trees ascend together, one bit a step, until the rows below the
reached nodes are ``breadth`` times the shard's rows or more.  Exact distances rank all
rows found.  Every row is indexed; nothing is sampled.

Random vectors of 64 dimensions, as in the test tables, have neighbours barely nearer
than the rest, so a recall of 0.9 and more takes a large breadth; for clustered vectors
a small one is enough.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors

TREES = 128
BITS = 20
BREADTH = 0.45
SEED = 17


class Forest:
    def __init__(self, matrix: np.ndarray, k: int, trees: int, bits: int, breadth: float, seed: int):
        self.matrix, self.k, self.bits = matrix, k, bits
        self.target = min(len(matrix), max(k + 1, breadth * len(matrix)))
        self.planes = np.random.default_rng(seed).normal(size=(trees, matrix.shape[1], bits))
        self.centre = matrix.mean(0)
        codes = self.hash(matrix)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, 1)
        self.norms = (matrix * matrix).sum(1)

    def hash(self, x: np.ndarray) -> np.ndarray:
        """``(trees, rows)`` hash strings as integers, first bit highest."""
        weight = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return np.stack([((x - self.centre) @ p > 0) @ weight for p in self.planes])

    def candidates(self, q: np.ndarray) -> np.ndarray:
        codes = self.hash(q[None])[:, 0]
        found = np.zeros(len(self.matrix), dtype=bool)
        # longest prefix match of each tree: the better of the two neighbours in sorted order
        n = len(self.matrix)
        at = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, codes, strict=True)])
        rows = np.arange(len(codes))
        apart = np.minimum(codes ^ self.sorted[rows, np.minimum(at, n - 1)], codes ^ self.sorted[rows, np.maximum(at - 1, 0)])
        depth = self.bits - np.array([int(a).bit_length() for a in apart])
        # synchronous ascent; a tree joins at its own longest match
        for level in range(int(depth.max()), -1, -1):
            shift = self.bits - level
            low = (codes >> shift) << shift
            total, spans = 0, []
            for s, o, a, d in zip(self.sorted, self.order, low, depth, strict=True):
                if d >= level:
                    i, j = np.searchsorted(s, (a, a + (1 << shift)))
                    total += j - i
                    spans.append(o[i:j])
            if total >= self.target:  # repeats included, so perhaps not yet enough rows
                found[np.concatenate(spans)] = True
                if np.count_nonzero(found) >= self.target:
                    break
        return np.flatnonzero(found)

    def search(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.candidates(q)
        rough = self.norms[at] - 2 * (self.matrix[at] @ q)
        at = at[vectors.with_ties(rough, self.k + 1, 1e-9 * (1 + abs(rough).max()))]
        cost = np.sqrt(((self.matrix[at] - q) ** 2).sum(1))
        best = vectors.with_ties(cost, self.k + 1)
        return at[best], cost[best]


def nearest(table: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES,
            bits: int = BITS, breadth: float = BREADTH, seed: int = SEED) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest found, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``.  Vectors that are null, empty, zero or hold
    null or non-finite components take no part, neither do null ids; vectors of different
    dimensions are not compared.  Ids should be unique: rows that repeat an id count as one
    more copy with that id.  The query set may be of any size (see ``vectors``).  An empty table gives no rows; other columns are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter(vectors.usable(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # -0.0 becomes 0.0

    def prepare(matrix: np.ndarray):
        return Forest(matrix, k, trees, bits, breadth, seed).search

    return vectors.top_k(rows, is_query, k, prepare, False, "double")
