"""Fill-in-middle against a plain version, exact round trips and edge cases."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import fill_in_middle as fim
from quire.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", "\n", "a", "a\n", "a\nb", "\n\n\n", "é\nüü\n🎉", "x<P>y\nz", "no <M> here", "<S>", "a\r\nb\r\n", "<\nP>", "end <", "S>\n<P", "k l\x0bm\n", "\0\n\0"]


def plain_version(doc_id, text, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_texts(k, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab é\n\n<>PSM") for _ in range(rng.randint(0, 40))) for _ in range(k)]


@pytest.fixture(scope="module")
def rows():
    texts = TEXTS + random_texts(300) + ["line\n" * 20_000, "w " * 100_000, "same\ntext\n"] + ["same\ntext\n"] * 3
    out = [(i, t, "clash", 5, "x") for i, t in enumerate(texts)]
    return out + [(None, "null\nid\n", "clash", 5, "x"), (None, None, None, None, None), (3, "other\ntext\nof\n3", "c", 1, "x")]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, form string, n int, output string").repartition(3)


def by_row(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (0, 100)])
def test_equals_a_plain_version(spark, rows, rate, spm):
    got = fim.fill_in_middle(table(spark, rows), rate=rate, spm_rate=spm).collect()
    assert by_row(map(tuple, got)) == by_row(plain_version(r[0], r[1], rate, spm) for r in rows)


def test_texts_are_rebuilt_exactly(spark, rows):
    found = fim.fill_in_middle(table(spark, rows))
    got = found.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert by_row(map(tuple, got)) == by_row((r[0], r[1] or "") for r in rows)


def test_slices_do_not_change_anything(spark, rows, monkeypatch):
    batch = pa.RecordBatch.from_pydict({"text": pa.array([r[1] for r in rows], pa.string())})
    for limit in (1, 50, 10_000_000):
        parts = list(fim.slices(batch, limit))
        assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()


def test_other_sentinels(spark):
    marks = ("[[pre]]", "[[suf]]", "[[mid]]")
    rows = [(i, t, "", 0, "") for i, t in enumerate(random_texts(50))]
    found = fim.fill_in_middle(table(spark, rows), sentinels=marks)
    got = found.select("doc_id", fim.restored(F.col("output"), F.col("form"), marks).alias("text")).collect()
    assert by_row(map(tuple, got)) == by_row((r[0], r[1]) for r in rows)
    for bad in (("a", "a", "b"), ("", "b", "c"), ("ab", "ba", "x"), ("a<", "xa<y", "q"), ("aa", "b", "c")):
        with pytest.raises(ValueError):
            fim.check_sentinels(bad)


def test_empty_table(spark):
    assert fim.fill_in_middle(table(spark, []).limit(0)).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in docs:
        doc_id, n, form, p, m, output = plain_version(r.doc_id, r.text)
        want.append((doc_id, n, form, p, m, sha(output), sha(r.text or "")))
    got = QUERIES["op12_fill_in_middle"](spark, SF)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert len({w[2] for w in want}) > 1
