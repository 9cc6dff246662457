"""The stage that drops copies: its own rule, and rows with repeated or null ids."""

import numpy as np
import pytest

import corpus_pipeline as cp
from quire.llm import jaccard
from test_jaccard import shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(4000)]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    return [" ".join(rng.choice(WORDS, 50)) for _ in range(12)]


def kept(spark, rows, path=None):
    docs = spark.createDataFrame([(i, t, s, s, 1) for i, t, s in rows], SCHEMA).repartition(3)
    if path:
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    return sorted(((r.doc_id, r.source) for r in cp.drop_copies(spark, docs, "").collect()), key=repr)


@pytest.mark.parametrize("written", [True, False])
def test_rows_with_repeated_and_null_ids(spark, texts, tmp_path, written):
    a, b, c, d, e, f = texts[:6]
    rows = [
        (1, a, "a"), (1, a, "a"),  # loaded twice
        (2, a, "copy"), (2, b, "b"),  # an id with a copy and a clean text
        (None, c, "c"), (None, c, "c"), (None, c, "c"),
        (None, d, "null copy"), (7, d, "d"),
        (None, e, "e"), (None, f, "f"),
        (None, None, "none"), (None, None, "none"), (8, "", "empty"),
    ]
    want = [(1, "a"), (2, "b"), (7, "d"), (8, "empty"), (None, "c"), (None, "e"), (None, "f"), (None, "none"), (None, "none")]
    assert kept(spark, rows, f"{tmp_path}/docs.parquet" if written else None) == sorted(want, key=repr)


def test_near_copies_by_five_words_and_four_fifths(spark):
    # against brute force; pairs between this rule and that of op10_jaccard_join are copies here
    rng = np.random.default_rng(9)
    rows = []
    for n, edits in ((50, 1), (500, 9), (60, 2), (50, 2), (200, 30), (40, 0), (4, 0), (300, 14)):
        base = list(rng.choice(WORDS, n))
        near = list(base)
        for at in np.linspace(5, n - 6, edits).astype(int) if edits else ():
            near[at] = "changed"
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(near)), (len(rows) + 2, " ".join([*near, "more"]))]
    sets = [shingles(t, 5) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    want = sorted(set(group))
    assert 1 not in want and 4 not in want  # one word of 50, nine of 500
    assert sorted(i for i, _ in kept(spark, [(i, t, "s") for i, t in rows])) == want


def test_null_ids_fetch_one_text_a_class(spark, monkeypatch, tmp_path):
    # the second pass reads one row of each class, however many rows share its id
    rng = np.random.default_rng(6)
    bases = [list(rng.choice(WORDS, 50)) for _ in range(12)]
    rows = [(None, " ".join([*t, *rng.choice(WORDS, k)])) for t in bases for k in (0, 1, 1, 2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs.parquet")
    calls, plain = f"{tmp_path}/calls", jaccard.shingle_hashes

    def counted(text, words):
        with open(calls, "a") as f:
            f.write("x")
        return plain(text, words)

    monkeypatch.setattr(jaccard, "shingle_hashes", counted)
    jaccard.link_components(spark.read.parquet(f"{tmp_path}/docs.parquet")).collect()
    with open(calls) as f:
        assert len(rows) < len(f.read()) <= 2 * len(rows)


def test_clashing_names(spark, tmp_path):
    rows = [(i, "one two three four five six seven" if i < 2 else f"word{i} and other{i} text{i} here{i} now{i}", i, i, i) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_file long, row_at long, n long")
    docs.write.parquet(f"{tmp_path}/d")
    for table in (docs, spark.read.parquet(f"{tmp_path}/d")):
        got = jaccard.first_of_components(table, 3, 90)
        assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [0, 2, 3, 4]
