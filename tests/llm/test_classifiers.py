"""Toxicity and quality: held-out accuracy on the given labels, parts against plain versions, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import quality, toxicity
from quire.llm.common import in_fold, score_texts
from quire.llm.queries import QUERIES, TOXIC_FOLDS, fitted

SF = "/root/testdata/sf0.01"


def held_out_result(spark, query, column):
    rows = QUERIES[query](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(column).alias("y"))
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    return rows.join(labels, "doc_id").toPandas()


@pytest.mark.parametrize("query, column, least", [("op1_toxicity", "toxic", 0.95), ("op5_quality_classifier", "quality", 0.95)])
def test_held_out_accuracy(spark, query, column, least):
    got = held_out_result(spark, query, column)
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    unseen = got[got["held_out"]]
    assert len(unseen) > 50 and (unseen["predicted"] == unseen["y"]).mean() >= least
    # accuracy alone says little where one label is rare
    for label in (0, 1):
        said, is_ = unseen["predicted"] == label, unseen["y"] == label
        # only six unseen rows of this table are toxic (four caught, one false when written), and some toxic labels have no toxic word (README)
        recall, precision = (0.6, 0.75) if (column, label) == ("toxic", 1) else (0.95, 0.9)
        assert (said & is_).sum() / is_.sum() >= recall
        assert (said & is_).sum() / said.sum() >= precision


def test_folds(spark):
    import zlib

    rows = spark.range(200).select("id", in_fold(F.col("id"), 5, 0).alias("a"), in_fold(F.col("id"), 3, 1).alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(zlib.crc32(str(r.id).encode()) % 5 == 0, zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows]


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(3)
    n, m = 40_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.15
    hit = rng.uniform(0.55, 0.9, m)
    votes = np.where(y[:, None], rng.random((n, m)) < hit, rng.random((n, m)) < 0.03)
    votes[:, 1] = votes[:, 0]  # a copy of another voter
    votes[:, 11:] = rng.random((n, m - 11)) < 0.2  # voters that know nothing
    patterns, at, counts = np.unique(toxicity.pattern_of(votes), return_inverse=True, return_counts=True)
    every = (patterns[:, None] >> np.arange(m)) & 1
    model = toxicity.fit_label_model(every, counts.astype(float), 0.1)
    assert abs(model.prior - 0.15) < 0.02
    assert any({0, 1} <= set(b) for b in model.blocks)
    assert ((model.posterior(every)[at] >= 0.5) == y).mean() > 0.99
    fire = {b[0]: t[:, 1] for b, t in zip(model.blocks, model.tables) if len(b) == 1}
    for j in (2, 5):
        if j in fire:
            assert abs(fire[j][1] - hit[j]) < 0.05


def test_isotonic_is_monotone_and_fits():
    rng = np.random.default_rng(1)
    s = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-3 * s))).astype(float)
    knots, levels = quality.isotonic(s, y)
    assert (np.diff(knots) > 0).all() and (np.diff(levels) >= 0).all()
    assert np.mean((np.interp(s, knots, levels) - 1 / (1 + np.exp(-3 * s))) ** 2) < 0.01


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(2)
    d, m = len(quality.STATS), 20_000
    model = quality.QualityModel(
        np.zeros(d), np.ones(d), rng.normal(0, np.sqrt(quality.BANDWIDTH), (d, m)), rng.uniform(0, 2 * np.pi, m), np.zeros(m + 1), np.zeros(1), np.zeros(1)
    )
    x = rng.normal(size=(6, d)) * 0.7
    z = model.fourier(x)[:, :-1]
    exact = np.exp(-quality.BANDWIDTH / 2 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert abs(z @ z.T - exact).max() < 0.05


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_edge_cases(spark, operator):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "idiot " * 30_000), (5, "plain words here"), (5, "plain words here"), (None, "no id"), (6, "!!! $$$ ***")]
    docs = spark.createDataFrame([(*t, 0.3, 1) for t in texts], "doc_id long, text string, score double, label int").repartition(3)
    some = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (2, None), (None, 1)], "doc_id long, label int")
    for labels in (some, some.limit(0)):
        model = operator.fit(docs, labels)
        got = score_texts(docs, model).collect()
        assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert score_texts(docs.limit(0), operator.fit(docs.limit(0), some)).collect() == []


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_ids_that_many_rows_share_teach_once(spark, operator):
    rows = [(i % 3, f"text {i} of an id that is not its own " + ("idiot scum " if i % 3 == 1 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "doc_id long, label int")
    model = operator.fit(docs, labels, fit_rows=3)
    assert score_texts(docs, model).count() == len(rows)
    if operator is toxicity:
        assert {r.doc_id for r in score_texts(docs, model).filter("predicted = 1").collect()} <= {1}


def test_a_filter_on_the_score_scores_once(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    plan = score_texts(docs, quality.fit(docs, docs.select("doc_id", F.lit(1).alias("label")).limit(0))).filter("predicted = 1")
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_toxic_words_are_learnt_from_labels(spark):
    rng = np.random.default_rng(4)
    plain = [f"w{a}{b}ord" for a in "abcdefghij" for b in "klmnopqrst"]
    plain = [p.replace("w", "z") for p in plain]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(plain, 40))
        bad = i % 8 == 0
        if bad:
            words[3], words[20] = "grumpfel" + rng.choice(["a", "en", "ich"]), "snarkol"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int").withColumnRenamed("toxic", "label")
    model = fitted(toxicity, docs, known.withColumnRenamed("label", "toxic"), "toxic", TOXIC_FOLDS)
    got = {r.doc_id: r.predicted for r in score_texts(docs, model).collect()}
    assert got == dict(labels)
