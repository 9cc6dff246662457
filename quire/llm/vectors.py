"""What the two vector searches share: classes of equal vectors, query blocks, merging.

Equal vectors form one class, which keeps the ``k + 1`` smallest ids of its rows (a
map-side group limit, so a vector that a third of the rows share costs a few rows).  No
other id of a class can be among any query's ``k`` results, as ties go to smaller ids.

The stated query set is searched against all rows in a grid: distinct rows are dealt to
shards and distinct query vectors to lanes, both of bounded size, and a task works on one
cell of the grid.  It builds the index of the shard once, lets the lane's queries pass by
and returns the ``k + 1`` best rows for each; the shards' results are merged by a group
limit.  A query's own row is dropped at the end.  Nothing goes through the driver but two
counts, and the plan has one branch however many queries there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import map_batches, materialize

LANE_QUERIES = 32_768  # about so many distinct query vectors in a lane
SHARD_ROWS = 8192  # about so many distinct rows in a shard


def usable(vector: Column) -> Column:
    """False for null and empty vectors and for null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.coalesce(fine, F.lit(False))


def key_of(vector: Column) -> list[Column]:
    """128 bits that stand for a vector."""
    return [F.xxhash64(F.lit(seed), vector).alias(name) for seed, name in ((1, "k1"), (2, "k2"))]


KEYS = ["k1", "k2"]


def top_k(rows: DataFrame, is_query: Column, k: int, prepare: Callable, descending: bool, score_type: str) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of ``rows(vec_id, vector)``.

    ``prepare(matrix)`` gets a shard's vectors (float64) and returns a function from a
    query vector to ``(row numbers, costs)``: rows that hold the shard's ``k + 1``
    smallest costs and all ties with the last of them.  The score is the cost, negated if
    ``descending``.  Vectors of several dimensions are searched each among their own kind.
    """
    rows = rows.filter(F.col("vec_id").isNotNull()).select("vec_id", "vector", *key_of(F.col("vector")))
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= k + 1)
    grouped = kept.groupBy("vector").agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = materialize(grouped.withColumn("dim", F.size("vector")), "vector-classes")
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), *KEYS)
    wanted = materialize(classes.join(queries.select(*KEYS).distinct(), KEYS, "left_semi").select("dim", *KEYS, "vector"), "query-vectors")

    # a grid of cells: every shard of rows meets every lane of queries in one
    shards, lanes = max(1, math.ceil(classes.count() / SHARD_ROWS)), max(1, math.ceil(wanted.count() / LANE_QUERIES))
    shard, lane = (F.pmod(F.xxhash64(F.lit(seed), *KEYS), F.lit(n)).cast("int") for seed, n in (("shard", shards), ("lane", lanes)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stock = classes.select(shard.alias("shard"), every(lanes).alias("lane"), "dim", F.lit(False).alias("asks"), *KEYS, "vector", "ids")
    asked = wanted.select(every(shards).alias("shard"), lane.alias("lane"), "dim", F.lit(True).alias("asks"), *KEYS, "vector", F.lit(None).alias("ids"))
    cell = ["shard", "lane", "dim"]
    cells = stock.unionByName(asked).repartitionByRange(shards * lanes, *cell).sortWithinPartitions(*cell, "asks")
    found = map_batches(cells, _searcher(k, prepare), "k1 bigint, k2 bigint, vec_id bigint, cost double")
    best = Window.partitionBy(*KEYS).orderBy("cost", "vec_id")
    merged = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    order = Window.partitionBy("query_id").orderBy("cost", "vec_id")
    score = (-F.col("cost") if descending else F.col("cost")).cast(score_type)
    return (
        queries.join(merged, KEYS)
        .filter("vec_id != query_id")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", score.alias("score"))
    )


def _searcher(k: int, prepare: Callable) -> Callable:
    """Searches sorted cells: a cell's rows come first and make its index, then its queries pass by."""

    def index(rows: pd.DataFrame) -> Callable:
        ids = rows["ids"].to_numpy()
        first = np.array([x[0] for x in ids])
        run = prepare(np.stack(rows["vector"].to_numpy()).astype(float))

        def search(queries: pd.DataFrame) -> pd.DataFrame:
            out = []
            for key, vector in zip(queries[KEYS].to_numpy(np.int64), queries["vector"], strict=True):
                at, cost = run(np.asarray(vector, dtype=float))
                # classes by (cost, smallest id); the first k + 1 hold the k + 1 best rows
                order = np.lexsort((first[at], cost))[: k + 1]
                best = sorted((c, int(i)) for a, c in zip(at[order], cost[order], strict=True) for i in ids[a])
                out += [(*key, i, c) for c, i in best[: k + 1]]
            return pd.DataFrame(out, columns=["k1", "k2", "vec_id", "cost"]).astype({"k1": "int64", "k2": "int64", "vec_id": "int64", "cost": "float64"})

        return search

    def run_partition(batches):
        cell, held, search = None, [], None
        for b in batches:
            marks = b[["shard", "lane", "dim", "asks"]].to_numpy(np.int64)
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(b)], strict=True):
                part, here = b.iloc[start:end], tuple(marks[start, :3]) if end > start else cell
                if here != cell:
                    cell, held, search = here, [], None
                if end > start and not marks[start, 3]:
                    held.append(part)
                elif end > start and held:
                    search = search or index(pd.concat(held))
                    yield search(part)

    return run_partition


def with_ties(cost: np.ndarray, k: int, slack: float = 0.0) -> np.ndarray:
    """Positions of the ``k`` smallest costs and of all within ``slack`` of the last of them."""
    if len(cost) <= k:
        return np.arange(len(cost))
    return np.flatnonzero(cost <= np.partition(cost, k - 1)[k - 1] + slack)
