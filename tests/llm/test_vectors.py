"""Vector searches against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import ann, topk, vectors
from quire.llm.queries import ORACLE, QUERIES
from quire.session import scoped_conf

SF = "/root/testdata/sf0.01"
BAD = [(901, None), (902, []), (903, [None, 1.0]), (904, [float("nan"), 1.0]), (905, [float("inf"), 1.0]), (906, [1.0])]


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int").repartition(3)


def brute(rows, is_query, k, cost):
    out = []
    for q, x in rows:
        if is_query(q):
            best = sorted((cost(x, y), i) for i, y in rows if i != q)[:k]
            out += [(q, n, i, c) for n, (c, i) in enumerate(best, 1)]
    return sorted(out)


def distance(x, y):
    return float(np.sqrt(((np.array(y) - np.array(x)) ** 2).sum()))


def product(x, y):
    return -int(sum(np.floor(1024 * a) * np.floor(1024 * b) for a, b in zip(x, y, strict=True)))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = [(int(i), [float(v) for v in rng.normal(size=2)]) for i in rng.permutation(300)]
    same = out[0][1]
    return out + [(1000 + i, same) for i in range(60)]  # many copies of one vector


def test_exact_top_k_equals_brute_force(spark, rows):
    got = topk.highest_products(table(spark, rows + BAD), F.col("vec_id") % 7 == 0, k=5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, -r.score) for r in got) == brute(rows, lambda q: q % 7 == 0, 5, product)


def test_top_k_with_small_blocks_and_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(vectors, "LANE_QUERIES", 7)
    monkeypatch.setattr(vectors, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 6)
    got = topk.highest_products(table(spark, rows), F.col("vec_id") % 7 == 0, k=5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, -r.score) for r in got) == brute(rows, lambda q: q % 7 == 0, 5, product)


def test_one_plan_branch_and_one_index_per_shard(spark, rows, monkeypatch, tmp_path):
    # three batches of queries pass by the index of each shard
    monkeypatch.setattr(vectors, "SHARD_ROWS", 200)
    made = tmp_path / "indexes"

    def prepare(matrix):
        with made.open("a") as f:
            f.write(f"{len(matrix)}\n")
        return topk.Index(matrix, 3).search

    with scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "40"}):
        found = vectors.top_k(table(spark, rows).select("vec_id", F.col("embedding").alias("vector")), F.col("vec_id") % 3 == 0, 3, prepare, True, "bigint")
        assert len(found.collect()) == 3 * sum(i % 3 == 0 for i, _ in rows)
        assert found._jdf.queryExecution().toString().count("MapInPandas") <= 6  # one in each form of the plan and its final stages
    sizes = [int(x) for x in made.read_text().split()]
    assert len(sizes) == 2 and sum(sizes) == 300


def test_dimensions_are_searched_among_their_own_kind(spark, rows):
    three = [(5000 + i, [float(i % 5), float(i), 1.0]) for i in range(40)]
    got = topk.highest_products(table(spark, rows + three + [(7000, [2.0])]), F.col("vec_id") % 7 == 0, k=5).collect()
    want = brute(rows, lambda q: q % 7 == 0, 5, product) + brute(three, lambda q: q % 7 == 0, 5, product)
    assert sorted((r.query_id, r["rank"], r.vec_id, -r.score) for r in got) == sorted(want)


def test_max_score_index_alone():
    rng = np.random.default_rng(9)
    for d, n, k in ((3, 50, 4), (40, 3000, 10), (64, 9000, 10)):
        m = np.floor(rng.normal(size=(n, d)) * rng.choice([5, 200], d))
        m[rng.random((n, d)) < 0.5] = 0
        index = topk.Index(m, k)
        for _ in range(5):
            q = np.floor(rng.normal(size=d) * 100)
            at, cost = index.search(q)
            score = m @ q
            last = np.sort(score)[::-1][k]
            assert set(np.flatnonzero(score > last)) <= set(at) and set(at) == set(np.flatnonzero(score >= last))
            assert (cost == -score[at]).all()
    huge = topk.Index(np.array([[2.0**60, 1.0], [2.0**60, 0.0], [1.0, 1.0]]), 1)
    assert set(huge.search(np.array([2.0**40, 3.0]))[0]) == {0, 1}


def test_whole_forest_equals_brute_force(spark, rows):
    got = ann.nearest(table(spark, rows + BAD + [(907, [0.0, 0.0])]), F.col("vec_id") % 7 == 0, k=5, trees=4, breadth=1.0).collect()
    want = brute(rows, lambda q: q % 7 == 0, 5, distance)
    assert [x[:3] for x in sorted((r.query_id, r["rank"], r.vec_id) for r in got)] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)], [x[3] for x in want])


def test_recall(spark):
    got = QUERIES["op4_nearest_neighbours"](spark, SF).toPandas()
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x, ids = np.stack(e["embedding"].to_numpy()).astype(float), e["vec_id"].to_numpy()
    hits = 0
    queries = ids[ids % 100 == 0]
    for q in queries:
        mine = got[got["query_id"] == q].sort_values("rank")
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hits += len(set(ids[order]) & set(mine["vec_id"]))
        assert list(mine["rank"]) == list(range(1, 11))
        assert np.allclose(mine["score"], [d[ids == i][0] for i in mine["vec_id"]])
    assert hits / (10 * len(queries)) >= 0.9


def test_recall_on_clustered_vectors_with_a_small_breadth():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(200, 32))
    m = (centres[:, None] + 0.15 * rng.normal(size=(200, 25, 32))).reshape(-1, 32)
    forest = ann.Forest(m, 10, 24, 20, 0.02, 1)
    hits = seen = 0
    for q in m[::50]:
        d = np.sqrt(((m - q) ** 2).sum(1))
        hits += len(set(np.argsort(d)[:11]) & set(forest.search(q)[0]))
        seen += len(forest.candidates(q))
    assert hits / (11 * 100) >= 0.9 and seen / 100 < 0.1 * len(m)


def test_query_against_its_oracle(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.sql(ORACLE["op8_top_k"]).fetchall())
    assert sorted(map(tuple, QUERIES["op8_top_k"](spark, SF).collect())) == want


@pytest.mark.parametrize("search", [ann.nearest, topk.highest_products])
def test_few_and_no_vectors(spark, search):
    one = table(spark, [(0, [1.0, 2.0]), *BAD])
    assert search(one, F.col("vec_id") % 100 == 0).collect() == []
    assert search(one.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    two = search(table(spark, [(0, [1.0, 2.0]), (5, [1.0, 2.0])]), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in two] == [(0, 1, 5)]
