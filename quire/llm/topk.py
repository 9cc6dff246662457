"""Exact top-k search by MaxScore over sharded inverted indexes.

A dimension is a term; its list holds the rows' integer weights.  For a query the
contributions of a list are shifted by the least one, so that they start at 0 and the
list's score bound is the largest.  Lists are ordered by bound.  Those at the end whose
bounds together cannot lift a row over the current threshold are non-essential: a row's
sum over the essential lists, plus all their bounds, decides whether it is competitive.
Competitive rows are probed list by list, highest bound first, and dropped as soon as
their sum plus the bounds left falls short.  The threshold is the (k+1)-th best full
score so far; it starts from rows at the top of the lists with the highest bounds and
rises block by block.  Shards are merged by a group limit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors

BLOCK_ROWS = 4096
PROBE = 8  # lists probed between two looks at the threshold
SEED_LISTS, SEED_ROWS = 8, 16
SCALE = 1024
EXACT = 2.0**53


class Index:
    """The lists of one shard: weights in row order, and the rows in order of weight."""

    def __init__(self, matrix: np.ndarray, k: int):
        self.k = k
        self.weights = matrix
        self.low, self.high = matrix.min(0), matrix.max(0)
        rows = min(SEED_ROWS, len(matrix))
        order = np.argsort(matrix, axis=0, kind="stable")
        self.lightest, self.heaviest = order[:rows], order[len(matrix) - rows :]
        self.top = max(abs(self.low).max(), abs(self.high).max())

    def search(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(q) * self.top * abs(q).max() >= EXACT:  # beyond exact doubles: Python integers
            whole = np.array([int(x) for x in q], dtype=object)
            score = np.array([[int(x) for x in row] for row in self.weights], dtype=object).reshape(len(self.weights), -1) @ whole
            order = sorted(range(len(score)), key=lambda i: -score[i])
            last = score[order[min(self.k, len(order) - 1)]]
            at = np.array([i for i in order if score[i] >= last])
            return at, -score[at].astype(float)
        ends = np.stack([q * self.low, q * self.high])
        least, bound = ends.min(0), ends.max(0) - ends.min(0)
        lists = np.argsort(-bound, kind="stable")
        base = least.sum()
        rest = np.append(np.cumsum(bound[lists][::-1])[::-1], 0.0)  # bounds from list i on
        seeds = np.unique(np.concatenate([(self.heaviest if q[d] > 0 else self.lightest)[:, d] for d in lists[:SEED_LISTS]]))
        at, score = seeds, self.weights[seeds] @ q
        threshold = self._threshold(score)
        kept_at, kept = [], []
        for start in range(0, len(self.weights), BLOCK_ROWS):
            block = self.weights[start : start + BLOCK_ROWS]
            # the last lists whose bounds stay below the threshold are non-essential
            essential = max(1, int(np.searchsorted(-rest, -(threshold - base), side="left"))) if np.isfinite(threshold) else len(lists)
            essential = min(essential, len(lists))
            some = lists[:essential]
            partial = block[:, some] @ q[some] - least[some].sum() + base
            rows = np.flatnonzero(partial + rest[essential] >= threshold)
            partial = partial[rows]
            for i in range(essential, len(lists), PROBE):
                some = lists[i : i + PROBE]
                partial = partial + block[np.ix_(rows, some)] @ q[some] - least[some].sum()
                live = partial + rest[min(i + PROBE, len(lists))] >= threshold
                rows, partial = rows[live], partial[live]
            kept_at.append(rows + start)
            kept.append(partial)
            threshold = max(threshold, self._threshold(np.concatenate(kept)))
        at, score = np.concatenate(kept_at), np.concatenate(kept)
        best = vectors.with_ties(-score, self.k + 1)
        return at[best], -score[best]

    def _threshold(self, score: np.ndarray) -> float:
        n = self.k + 1
        return float(np.partition(score, len(score) - n)[len(score) - n]) if len(score) >= n else -np.inf


def highest_products(table: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest inner products of ``floor(scale * x)``.

    ``is_query`` is a condition on ``vec_id``; ties go to the smaller id.  Vectors that are
    null, empty or hold null or non-finite components take no part, neither do null ids;
    vectors of different dimensions are not compared.  Components are exact up to 2 ** 53.
    The query set may be of any size (see ``vectors``).  An empty table gives no rows; other columns are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector")).filter(vectors.usable(F.col("vector")))
    # floor of a double is a bigint in Spark
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale)))))

    def prepare(matrix: np.ndarray):
        return Index(matrix, k).search

    return vectors.top_k(rows, is_query, k, prepare, True, "bigint")
